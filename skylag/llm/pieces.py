"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The model file is compiled into three parts. The normaliser maps a space to the space
mark and puts one mark in front. The piece transducer has an arc for every piece; a
character without a piece has arcs for its UTF-8 bytes (byte fallback). The weights
are in the tropical semiring: the length of a path is the sum of its weights, and
the encoding is the shortest path through the input composed with both.

- Unigram models: an arc weighs minus its piece's score.
- BPE models: merging by rank is a local rule, so a sequence of pieces is the BPE
  encoding exactly if each piece and each two neighbours encode to themselves: the
  first merge over a boundary would also happen in the two neighbours alone. The
  transducer has the last piece as its state; an arc between two pieces weighs 0 if
  they may be neighbours, else infinity. One path has finite weight.

No piece has a space mark behind another character, so a path passes a state without
memory before each word; words are composed one at a time, and a worker keeps those
it has seen lately.
"""

import re
import struct
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from skylag.llm.common import once_per_process, slices

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Words of each of the two generations whose ids a worker keeps, and neighbours whose test it keeps.
KEPT_WORDS, KEPT_PAIRS = 300_000, 1_000_000
# Bits of a symbol's code, the code of what stands before a word, and bytes of an id of a kept word.
CODE_BITS, ID_BYTES = 24, 4
BEFORE = (1 << CODE_BITS) - 1


class Transducer:
    """A compiled model: ``encode`` and ``decode`` of one text."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or not norm.escape_whitespaces:
            raise ValueError("only models without a character map are compiled")
        kinds = {p.type for p in model.pieces}
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or not model.trainer_spec.byte_fallback:
            raise ValueError("only models of normal pieces with byte fallback are compiled")
        self.bpe = model.trainer_spec.model_type == BPE
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.text = [p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self.pieces = [p.piece for p in model.pieces]
        self.byte_ids = [0] * 256
        for k, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = k
                self.text[k] = bytes([int(p.piece[3:-1], 16)])
            elif p.type in (CONTROL, UNKNOWN):
                self.text[k] = b"" if p.type == CONTROL else " ⁇ ".encode()
        # The lengths of the symbols that begin with three characters, the longest first.
        lengths: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                lengths.setdefault(p[:3], {1, 2} if p[:2] in self.ids else {1}).add(len(p))
        self.sizes = {begin: tuple(sorted(own, reverse=True)) for begin, own in lengths.items()}
        self.lowest = min(self.scores.values(), default=0.0)
        by_word = all(MARK not in p.lstrip(MARK) for p in self.ids)
        self.word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if by_word else "(?s).+")
        # A symbol's code is the id of its piece; characters without a piece get further ones.
        self.codes, self.symbols = dict(self.ids), list(self.pieces)
        # Words seen lately, and those before them that were not seen again.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.near: dict[int, bool] = {}

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def _merged(self, text: str) -> list[str]:
        """The BPE symbols of a short text: the best pair first, the left one of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _arcs(self, text: str, at: int):
        """The symbols that start at a place, the longest first."""
        for size in self.sizes.get(text[at:at + 3], (2, 1)):
            if size > 1 and text[at:at + size] in self.ids:
                yield text[at:at + size]
        yield text[at]  # a piece, or a character for byte fallback

    def _fits(self, last: int, code: int) -> bool:
        """Whether a symbol may follow another, or stand first. Two neighbours that encode to
        themselves do so each alone."""
        if len(self.near) >= KEPT_PAIRS:
            self.near.clear()
        parts = [self.symbols[code]] if last == BEFORE else [self.symbols[last], self.symbols[code]]
        fits = self.near[last << CODE_BITS | code] = self._merged("".join(parts)) == parts
        return fits

    def _shortest_bpe(self, text: str) -> list[str]:
        """The path of finite weight; all such weights are equal, so the agenda is a stack."""
        near, codes, sizes, n = self.near, self.codes, self.sizes, len(text)
        path: list[int] = []
        starts: list[int] = []
        dead: set[tuple[int, int]] = set()
        # Where the path ends, its last symbol, and how far the next one may reach.
        at, last, limit = 0, BEFORE, n
        while at < n:
            for size in sizes.get(text[at:at + 3], (2, 1)):
                to = at + size
                if to > limit:
                    continue
                code = codes.get(text[at:to])
                if code is None:
                    if size > 1:
                        continue
                    code = codes[text[at]] = len(self.symbols)
                    self.symbols.append(text[at])
                if dead and (to, code) in dead:
                    continue
                fits = near.get(last << CODE_BITS | code)
                if fits or fits is None and self._fits(last, code):
                    path.append(code)
                    starts.append(at)
                    at, last, limit = to, code, n
                    break
            else:
                # No arc leads on from this state, whatever came before it.
                dead.add((at, path.pop()))
                limit, at = at - 1, starts.pop()
                last = path[-1] if path else BEFORE
        return [self.symbols[code] for code in path]

    def _shortest_unigram(self, text: str) -> list[str]:
        scores, n = self.scores, len(text)
        best, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for at in range(n):
            for symbol in self._arcs(text, at):
                weight = best[at] - scores.get(symbol, self.lowest - UNKNOWN_PENALTY)
                if weight < best[at + len(symbol)]:
                    best[at + len(symbol)], back[at + len(symbol)] = weight, at
        path = []
        while n:
            path.append(text[back[n]:n])
            n = back[n]
        return path[::-1]

    def _closed(self, word: str) -> bytes | None:
        """Ids of a known word and a closing mark, if the two may be neighbours as they are."""
        before = self.known.get(word[:-1]) or self.older.get(word[:-1])
        mark = self.ids.get(word[-1])
        if not before or mark is None:
            return None
        last = int.from_bytes(before[-ID_BYTES:], "little")
        if self.ids.get(self.pieces[last]) != last:
            return None
        fits = self.near.get(last << CODE_BITS | mark)
        if fits is None:
            fits = self._fits(last, mark)
        return before + mark.to_bytes(ID_BYTES, "little") if fits else None

    def _word(self, word: str) -> bytes:
        if self.bpe and word[-1] in ".,;:!?" and (closed := self._closed(word)):
            return closed
        out = []
        for symbol in (self._shortest_bpe if self.bpe else self._shortest_unigram)(word):
            if symbol in self.ids:
                out.append(self.ids[symbol])
            else:
                out += [self.byte_ids[b] for b in symbol.encode()]
        return struct.pack(f"<{len(out)}i", *out)

    def encode_flat(self, text: str) -> bytes:
        """The ids of a text, as little-endian integers of 32 bits."""
        if len(self.known) >= KEPT_WORDS:
            self.known, self.older = {}, self.known
        known, older, out = self.known, self.older, []
        for word in self.word.findall(self.normalise(text)):
            ids = known.get(word)
            if ids is None:
                ids = older.get(word) or self._word(word)
                if len(word) <= 64 and len(known) < KEPT_WORDS:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        flat = self.encode_flat(text)
        return list(struct.unpack(f"<{len(flat) // ID_BYTES}i", flat))

    def decode(self, ids: list[int] | tuple[int, ...]) -> str:
        """The text of ids: bytes that are no UTF-8 become replacement characters."""
        text = self.text
        whole = b"".join([text[k] for k in ids]).decode("utf-8", "replace")
        return whole[1:] if self.prefix and whole[:1] == " " else whole


def compiled(path: str) -> Transducer:
    return once_per_process(f"pieces {path}", lambda: Transducer(path))


def encode(documents: DataFrame, model: str) -> DataFrame:
    """The documents with a column ``piece_ids``, null for a null text, which comes last.

    An empty text has no ids. An input column of that name is replaced.
    """
    documents = documents.drop("piece_ids")
    at = documents.columns.index("text")

    def run(batches):
        import pyarrow as pa

        fst = compiled(model)
        for batch in batches:
            texts = (batch.column(at)[k].as_py() for k in range(batch.num_rows))
            ids = pa.array([None if t is None else fst.encode(t) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "piece_ids"])

    schema = StructType([*documents.schema.fields, StructField("piece_ids", ArrayType(IntegerType()))])
    return documents.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``doc_id, piece_ids`` as ``doc_id, text``; null ids give a null text."""

    def run(batches):
        import pyarrow as pa

        fst = compiled(model)
        for batch in batches:
            ids = batch.column(1)
            texts = [None if not ids[k].is_valid else fst.decode(ids[k].as_py()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "piece_ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, model: str) -> DataFrame:
    """Encode and decode every whole text in one pass.

    Columns ``doc_id, n_ids, piece_ids, decoded_crc32, same``: crc32 of the decoded text
    in UTF-8, and whether it equals the text. A null text counts as empty. Only a text
    that holds the space mark itself decodes to another text.
    """

    def run(batches):
        import pyarrow as pa

        fst = compiled(model)
        for batch in slices(batches):
            texts, flat, ends, crc, same = batch.column(1), [], [0], [], []
            for k in range(batch.num_rows):
                text = texts[k].as_py() or ""
                own = fst.encode_flat(text)
                n = len(own) // ID_BYTES
                back = fst.decode(struct.unpack(f"<{n}i", own))
                flat.append(own)
                ends.append(ends[-1] + n)
                crc.append(zlib.crc32(back.encode()))
                same.append(back == text)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(flat))])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            counts = [b - a for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), ids, pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                ["doc_id", "n_ids", "piece_ids", "decoded_crc32", "same"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_ids long, piece_ids array<int>, decoded_crc32 long, same boolean"
    )
