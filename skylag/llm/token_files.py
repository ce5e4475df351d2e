"""Token ids as flat unsigned integer files with 64-bit document offsets.

A part is two files: ``<part>.ids`` holds the ids of its documents one after the other,
``<part>.idx`` holds one document id and one offset (ids before the document, inside
the part) per document, all little-endian. The manifest has a row per part with its
``base``, the number of ids in all parts before it, from a prefix sum. So a reader
maps a part into memory and knows every document's place in the whole.
"""

import os
import uuid
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import LOWER, open_store, once_per_process, shared_uri, spread, stored

# Words of each of the two generations whose ids a worker keeps.
KEPT_WORDS = 700_000
# Texts, and characters of texts, that are encoded at a time.
TEXTS, CHARS = 512, 1 << 21
# A character whose token stands between words that are encoded in one call.
BETWEEN = "•"
# Marks that are tokens of their own behind an ASCII letter or digit.
TAIL = tuple(b".,;:!?"[k:k + 1] for k in range(6))


class WordEncoder:
    """Encodes texts word by word with a tokenizer that never merges across white space.

    Words are maximal runs without ASCII white space, and a text's ids are those of its
    words. This holds for tokenizers whose pre-tokenizer drops white space, folds A-Z and
    parts a closing mark from a word (checked by ``by_words`` on probes); others, and texts
    that hold ``<|`` as special tokens do, are encoded whole. Unseen words go to the
    library together: those of letters only end with one end-of-word token each, others
    are parted by a character with a known id.
    """

    def __init__(self, path: str, width: str):
        import numpy as np
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.width = Tokenizer.from_file(path), width
        # Words seen lately, and those before them that were not seen again.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.between = self.ids(BETWEEN)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        if suffix:
            self.ends[[k for t, k in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.by_word = bool(suffix) and self.by_words()

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def by_words(self) -> bool:
        one, two = self.ids("Ab, c1"), self.ids("deé F.")
        return len(self.between) == 1 and one == self.ids("ab, c1") and all(
            self.ids(f"Ab, c1{gap}deé F.") == one + two and self.ids(f"Ab,{gap}c1") == self.ids("Ab,") + self.ids("c1")
            for gap in (" ", "\n", "\t\r", "\x0b\x0c")
        ) and all(self.ids(f"Ab{m.decode()} c") == self.ids("ab") + self.ids(m.decode()) + self.ids("c") for m in TAIL)

    def _bytes(self, ids) -> bytes:
        import numpy as np

        return np.asarray(ids, dtype=self.width).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """Ids of new words, those with a closing mark from their parts."""
        parted = {w for w in words if w.endswith(TAIL) and w[-2:-1].isalnum()}
        plain = words - parted
        plain.update(p for w in parted for p in (w[:-1], w[-1:]) if p not in self.known)
        letters, mixed = [], []
        for w in plain:
            text = w.decode()
            (letters if text.isalpha() else mixed).append(text)
        self._encode(letters, " ", lambda ids: self.ends[ids], 1)
        single = [t for t in mixed if BETWEEN in t]
        mixed = [t for t in mixed if BETWEEN not in t]
        self._encode(mixed, f" {BETWEEN} ", lambda ids: ids == self.between[0], 0)
        for text in single:
            self.known[text.encode()] = self._bytes(self.ids(text))
        for w in parted:
            self.known[w] = self.known[w[:-1]] + self.known[w[-1:]]

    def _encode(self, words: list[str], joint: str, edge, own: int) -> None:
        """Encode words in one call and cut the ids at the edges, which belong to a word if ``own``."""
        import numpy as np

        if not words:
            return
        ids = np.array(self.ids(joint.join(words) + (joint if not own else "")), dtype=np.int64)
        stops = np.flatnonzero(edge(ids))
        if len(stops) != len(words):
            self.known.update((w.encode(), self._bytes(self.ids(w))) for w in words)
            return
        flat, size = self._bytes(ids), np.dtype(self.width).itemsize
        stops = stops.tolist()
        starts = [0, *(k + 1 for k in stops[:-1])]
        for word, a, b in zip(words, starts, stops):
            self.known[word.encode()] = flat[a * size:(b + own) * size]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of the given width."""
        split = []
        for text in texts:
            data = text.encode()
            whole = not self.by_word or b"<|" in data
            split.append(None if whole else data.translate(LOWER).split())
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*(words for words in split if words)).difference(known)
        again = older.keys() & new
        known.update((w, older[w]) for w in again)
        new -= again
        if new:
            self._learn(new)
        return [
            self._bytes(self.ids(text)) if words is None else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, split)
        ]


def id_width(path: str) -> str:
    """The smallest unsigned type that holds every id of a vocabulary."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return "<u2" if size <= 1 << 16 else "<u4"


def taken(texts, most: int = TEXTS, chars: int = CHARS):
    """Lists of the texts of an Arrow column in order, null as empty: so many, and about so many characters."""
    own, held = [], 0
    for text in texts:
        own.append(text.as_py() or "")
        held += len(own[-1])
        if len(own) >= most or held >= chars:
            yield own
            own, held = [], 0
    if own:
        yield own


def write_tokens(documents: DataFrame, uri: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; the manifest of the parts.

    Rows are dealt by ranges of doc_id, so parts follow each other. A null text is
    empty, a null doc_id comes first, and rows with one doc_id are ordered by text. A part file
    counts only if its task's manifest row does, so a repeated task does no harm.
    """
    width = id_width(tokenizer)

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = once_per_process(f"words {tokenizer} {width}", lambda: WordEncoder(tokenizer, width))
        end, size = np.array([end_id], dtype=width).tobytes(), np.dtype(width).itemsize
        store, root = open_store(uri)
        store.create_dir(root)
        name, docs, nulls, tokens = f"part-{uuid.uuid4().hex}", 0, 0, 0
        ids = index = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if ids is None:
                ids = store.open_output_stream(f"{root}/{name}.ids")
                index = store.open_output_stream(f"{root}/{name}.idx")
            for texts in taken(batch.column(1)):
                made = encoder.encode(texts)
                ids.write(end.join(made) + end)
                stops = tokens + np.cumsum([len(own) // size + 1 for own in made])
                index.write(np.concatenate([[tokens], stops[:-1]]).astype("<i8").tobytes())
                tokens = int(stops[-1])
            docs, nulls = docs + batch.num_rows, nulls + batch.column(0).null_count
            # Document ids follow the offsets of their batch; the manifest says how long each stretch is.
            index.write(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([TaskContext.get().partitionId()], pa.int32()), "part": [name],
                "docs": pa.array([batch.num_rows], pa.int64()), "nulls": pa.array([batch.column(0).null_count], pa.int64()),
                "upto": pa.array([tokens], pa.int64()),
            })
        if ids is not None:
            ids.close()
            index.close()

    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        "doc_id", F.xxhash64("text")
    ).sortWithinPartitions("doc_id", F.xxhash64("text"))
    stretches = stored(ordered.mapInArrow(write, "place int, part string, docs long, nulls long, upto long"), "tokens-parts")
    parts = stretches.groupBy("place", "part").agg(
        F.max("upto").alias("tokens"), F.array_sort(F.collect_list(F.struct("upto", "docs", "nulls"))).alias("stretches")
    )
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), F.lit(width).alias("width"))


def read_tokens(manifest: DataFrame, uri: str) -> DataFrame:
    """Map every part and give ``doc_id, start, n_tokens, ids_crc32`` per document."""

    def mapped(store, path):
        import numpy as np
        from pyarrow import fs

        if isinstance(store, fs.LocalFileSystem) and store.get_file_info(path).size:
            return np.memmap(path, dtype="u1", mode="r")
        with store.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype="u1")

    def read(batches):
        import numpy as np
        import pyarrow as pa

        store, root = open_store(uri)
        for batch in batches:
            for part in batch.to_pylist():
                ids = mapped(store, f"{root}/{part['part']}.ids").view(part["width"])
                index = mapped(store, f"{root}/{part['part']}.idx").view("<i8")
                at = 0
                for stretch in part["stretches"]:
                    n = stretch["docs"]
                    starts, doc_ids = index[at:at + n], index[at + n:at + 2 * n]
                    at += 2 * n
                    stops = np.append(starts[1:], stretch["upto"])
                    # Nulls are first in the order of doc_id.
                    missing = np.arange(n) < stretch["nulls"]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), stops.tolist())]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(np.array(doc_ids), pa.int64(), mask=missing),
                        "start": pa.array(starts + part["base"], pa.int64()),
                        "n_tokens": pa.array(stops - starts, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    return spread(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write token files and read every document back from them.

    Further columns are ignored; an empty table gives no rows.
    """
    uri = shared_uri(documents.sparkSession, "tokens")
    manifest = stored(write_tokens(documents, uri, tokenizer, end_id), "tokens-manifest")
    return read_tokens(manifest, uri)
