"""Alignment of two tokenizers' tokens by sparse incidence matrices.

A text has tokens A (byte-level BPE of space + text) and B (pieces, which add the space
themselves). Each side is a token-byte incidence matrix in compressed rows, built by hand
from the token lengths. Row products A·Bᵀ by Gustavson's rule (each row of A collects the
rows of Bᵀ that its bytes name, and equal columns are added up) give the overlap links:
token pairs with the number of bytes they share. Offsets where both sides end a token cut
them into groups; the product of the two token-group incidence matrices gives the links
of tokens that share a group.

The vocabulary of side A is read from its tokenizers file and applied by tiktoken, which
gives the same ids (tested on every code point) in a quarter of the time.

Texts that are null, empty, or whose joined bytes on either side differ from space + text
(they hold the space mark itself, for example) have no tokens. Repeated rows are each
answered, and columns other than ``doc_id`` and ``text`` are ignored. Texts are taken
together up to ``CHUNK`` bytes; products of a longer text are made in blocks of rows.

Counts of id pairs cover the corpus. A block of documents asks for the pairs that it
holds, once each, so that the pairs are summed, ranked per B id and sent back per block,
not per link; a block has at most about ``BLOCK_ENTRIES`` entries, and a long document may
span blocks.
"""

import hashlib
import json
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import once_per_process, stored

CHUNK = 1 << 20
BLOCK_ENTRIES = 1 << 20
BLOCK_DOCS = 20_000
# Entries of a product that are held at a time.
PRODUCT = 1 << 21
# Fixed value: the character that stands for a space in pieces.
MARK = "▁"
# Fixed value: the words inside which byte-level tokens are merged (the public pattern of such vocabularies).
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Side:
    """Token bytes of one vocabulary: an array of lengths, and the bytes of every id."""

    def __init__(self, token_bytes: list[bytes]):
        import numpy as np

        self.bytes = token_bytes
        self.lengths = np.array([len(t) for t in token_bytes], dtype=np.int64)
        names = [str(k) for k in range(len(token_bytes))]
        self.inner = np.array([n + "," for n in names], dtype=object)


class Pair:
    """Both tokenizers with their token bytes."""

    def __init__(self, byte_level: str, pieces: str):
        import numpy as np
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = byte_letters()
        with open(byte_level, encoding="utf-8") as f:
            described = json.load(f)
        names = sorted(described["model"]["vocab"], key=described["model"]["vocab"].get)
        special = {t["content"] for t in described["added_tokens"]}
        self.side_a = Side([name.encode() if name in special else bytes(map(letters.__getitem__, name)) for name in names])
        # Ids rise with the rank of the merge that makes the token.
        ranks = {data: k for k, (data, name) in enumerate(zip(self.side_a.bytes, names)) if name not in special}
        self.a = tiktoken.Encoding("byte level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        b = self.b
        self.side_b = Side([
            bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k)
            else b.id_to_piece(k).replace(MARK, " ").encode() for k in range(b.get_piece_size())
        ])
        self.close_a = np.array([f"{k}|" for k in range(len(names))], dtype=object)
        self.close_b = np.array([f"{k};" for k in range(b.get_piece_size())], dtype=object)

    def encode(self, texts: list[str | None]) -> list[tuple | None]:
        """For each text the ids of both sides, None if it has no tokens."""
        import numpy as np

        given = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in given]
        ids_a = [self.a.encode_ordinary(t) for t in spaced]
        ids_b = self.b.encode([texts[k] for k in given], num_threads=1) if given else []
        out: list[tuple | None] = [None] * len(texts)
        for k, whole, a, b in zip(given, spaced, ids_a, ids_b):
            data = whole.encode()
            if (b"".join(map(self.side_a.bytes.__getitem__, a)) == data
                    and b"".join(map(self.side_b.bytes.__getitem__, b)) == data):
                out[k] = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        return out


def byte_letters() -> dict[str, int]:
    """The printable letter of every byte in a byte-level vocabulary: printable Latin-1
    stands for itself, the other bytes are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [k for k in range(256) if k not in plain]
    return {chr(k): k for k in plain} | {chr(256 + n): k for n, k in enumerate(others)}


def incidence(lengths):
    """Rows of a token-byte matrix: (row pointers, columns); bytes follow each other."""
    import numpy as np

    pointers = np.concatenate([[0], np.cumsum(lengths)])
    return pointers, np.arange(pointers[-1])


def transposed(matrix, columns: int):
    """The matrix with rows and columns exchanged."""
    import numpy as np

    pointers, cols = matrix
    rows = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))
    counts = np.bincount(cols, minlength=columns)
    return np.concatenate([[0], np.cumsum(counts)]), rows[np.argsort(cols, kind="stable")]


def row_products(a, b, columns: int):
    """The product of two 0/1 matrices, by Gustavson's rule, in blocks of rows of ``a``.

    Yields ``rows, cols, counts``, sorted, counts being the entries of the product. A
    block needs at most ``PRODUCT`` entries, or one row.
    """
    import numpy as np

    pointers, cols = a
    sizes = (b[0][1:] - b[0][:-1])[cols]
    ends = np.concatenate([[0], np.cumsum(sizes)])[pointers]
    first = 0
    while first < len(pointers) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PRODUCT, "right")) - 1)
        span = slice(pointers[first], pointers[last])
        named, size = cols[span], sizes[span]
        of_row = np.repeat(np.arange(first, last), np.diff(pointers[first:last + 1]))
        rows = np.repeat(of_row, size)
        before = np.cumsum(size) - size
        found = b[1][np.repeat(b[0][named] - before, size) + np.arange(len(rows))]
        key = rows * columns + found
        if len(key) and (key[1:] < key[:-1]).any():
            key.sort()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
        yield key[edge] // columns, key[edge] % columns, np.diff(np.append(edge, len(key)))
        first = last


class Aligned:
    """Tokens of some whole texts, one after the other: groups and links."""

    def __init__(self, pair: Pair, ids_a, ids_b):
        import numpy as np

        self.pair, self.ids_a, self.ids_b = pair, ids_a, ids_b
        self.len_a, self.len_b = pair.side_a.lengths[ids_a], pair.side_b.lengths[ids_b]
        ends_a, ends_b = np.cumsum(self.len_a), np.cumsum(self.len_b)
        self.size = int(ends_a[-1]) if len(ends_a) else 0
        end = np.zeros(self.size + 1, dtype=bool)
        end[ends_a] = True
        self.cut_b = end[ends_b]
        end[:] = False
        end[ends_b] = True
        self.cut_a = end[ends_a]
        self.group_a = np.cumsum(self.cut_a) - self.cut_a
        self.group_b = np.cumsum(self.cut_b) - self.cut_b
        self.groups = int(self.cut_a.sum())

    def overlaps(self):
        """Blocks ``a, b, bytes`` of the overlap links, as places of tokens."""
        by_byte = transposed(incidence(self.len_b), self.size)
        return row_products(incidence(self.len_a), by_byte, len(self.ids_b))

    def group_matrices(self):
        import numpy as np

        own = np.arange(len(self.ids_a) + 1), self.group_a
        other = np.arange(len(self.ids_b) + 1), self.group_b
        return own, transposed(other, self.groups)

    def shared(self):
        """Blocks ``a, b, 1`` of the links of tokens that share a group."""
        own, members = self.group_matrices()
        return row_products(own, members, len(self.ids_b))

    def shared_counts(self):
        """For every token A, its number of shared-group links: the product with a vector of ones."""
        own, members = self.group_matrices()
        return (members[0][1:] - members[0][:-1])[own[1]]

    def written(self):
        """The groups as text pieces in order: ``a1,a2|b1;``, one piece for each token."""
        import numpy as np

        p = self.pair
        n_a = np.bincount(self.group_a, minlength=self.groups)
        n_b = np.bincount(self.group_b, minlength=self.groups)
        start = np.cumsum(n_a + n_b) - n_a - n_b
        out = np.empty(len(self.ids_a) + len(self.ids_b), dtype=object)
        at_a = start[self.group_a] + np.arange(len(self.ids_a)) - (np.cumsum(n_a) - n_a)[self.group_a]
        at_b = (start + n_a)[self.group_b] + np.arange(len(self.ids_b)) - (np.cumsum(n_b) - n_b)[self.group_b]
        out[at_a] = np.where(self.cut_a, p.close_a[self.ids_a], p.side_a.inner[self.ids_a])
        out[at_b] = np.where(self.cut_b, p.close_b[self.ids_b], p.side_b.inner[self.ids_b])
        return out


def packed(numbers) -> bytes:
    """Whole numbers below 2^32, byte planes apart, so that the empty ones vanish."""
    import numpy as np

    planes = np.ascontiguousarray(np.asarray(numbers, dtype="<u4").view("u1").reshape(-1, 4).T)
    return zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes):
    import numpy as np

    planes = np.frombuffer(zlib.decompress(data), dtype="u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


BLOCKS = """block long, run string, number array<long>, doc_id array<long>, n_a array<long>, n_b array<long>,
    n_groups array<long>, n_links array<long>, n_shared array<long>, groups_sha256 array<string>,
    pairs array<long>, pair_n array<long>, owners binary, sizes binary, entries binary, times binary"""
DOC_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]


class _Block:
    """Collects document rows and entries (document, id pair, times) up to a bound."""

    def __init__(self):
        self.run, self.next = uuid.uuid4().hex, 0
        self.clear()

    def clear(self):
        self.docs, self.owner, self.pair, self.times, self.size = [], [], [], [], 0

    def add_entries(self, owner, pair, times):
        self.owner.append(owner)
        self.pair.append(pair)
        self.times.append(times)
        self.size += len(pair)

    def flush(self):
        import numpy as np
        import pyarrow as pa

        none = [np.empty(0, dtype=np.int64)]
        owner, pair, times = (np.concatenate(x or none) for x in (self.owner, self.pair, self.times))
        pairs, at = np.unique(pair, return_inverse=True)
        total = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(total, at, times)
        order = np.lexsort((at, owner))
        owner, at, times = owner[order], at[order], times[order]
        owners, first, sizes = np.unique(owner, return_index=True, return_counts=True)
        step = np.diff(at, prepend=0)
        step[first] = at[first]
        columns = list(zip(*self.docs)) if self.docs else [()] * 8
        kinds = [pa.int64()] * 7 + [pa.string()]
        low = int(owners[0]) if len(owners) else 0
        values = [
            [uuid.uuid4().int >> 66], [self.run], *[pa.array([list(c)], pa.list_(k)) for c, k in zip(columns, kinds)],
            pa.array([pairs], pa.list_(pa.int64())), pa.array([total], pa.list_(pa.int64())),
            pa.array([low.to_bytes(8, "little") + packed(owners - low)], pa.binary()),
            *[pa.array([packed(x)], pa.binary()) for x in (sizes, step, times)],
        ]
        names = [c.split()[0] for c in BLOCKS.split(",")]
        self.clear()
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], names)


def _align(block: _Block, pair: Pair, doc_ids: list, tokens: list):
    """Adds texts to the block; yields full blocks."""
    import numpy as np

    kept = [k for k, t in enumerate(tokens) if t is not None]
    none = np.empty(0, dtype=np.int64)
    numbers = np.arange(block.next, block.next + len(tokens))
    block.next += len(tokens)
    sizes_a = np.array([0 if t is None else len(t[0]) for t in tokens], dtype=np.int64)
    sizes_b = np.array([0 if t is None else len(t[1]) for t in tokens], dtype=np.int64)
    aligned = Aligned(
        pair,
        np.concatenate([tokens[k][0] for k in kept]) if kept else none,
        np.concatenate([tokens[k][1] for k in kept]) if kept else none,
    )
    of_a = np.repeat(np.arange(len(tokens)), sizes_a)
    n_links = np.zeros(len(tokens), dtype=np.int64)
    for a, b, _ in aligned.overlaps():
        doc = of_a[a]
        n_links += np.bincount(doc, minlength=len(tokens))
        ids = (aligned.ids_a[a] << 32) | aligned.ids_b[b]
        order = np.lexsort((ids, doc))
        doc, ids = doc[order], ids[order]
        edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (ids[1:] != ids[:-1])])) if len(doc) else none
        block.add_entries(numbers[doc[edge]], ids[edge], np.diff(np.append(edge, len(doc))))
        if block.size >= BLOCK_ENTRIES:
            yield block.flush()
    n_groups = np.bincount(of_a, weights=aligned.cut_a, minlength=len(tokens)).astype(np.int64)
    shared = np.bincount(of_a, weights=aligned.shared_counts(), minlength=len(tokens)).astype(np.int64)
    text, at = aligned.written(), 0
    for k, doc_id in enumerate(doc_ids):
        own = text[at:at + sizes_a[k] + sizes_b[k]].tolist()
        at += len(own)
        digest = hashlib.sha256("".join(own)[:-1].encode()).hexdigest() if own else ""
        block.docs.append((
            int(numbers[k]), doc_id, int(sizes_a[k]), int(sizes_b[k]), int(n_groups[k]), int(n_links[k]),
            int(shared[k]), digest,
        ))
    if len(block.docs) >= BLOCK_DOCS:
        yield block.flush()


def _chunks(batch):
    """The rows of a batch in runs of at most about ``CHUNK`` bytes of text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    first = total = 0
    for k, size in enumerate(sizes):
        if k > first and total + size > CHUNK:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size
    if batch.num_rows > first:
        yield batch.slice(first)


def aligned_blocks(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The documents' alignments as blocks: per document its counts, per block the id pairs it asks for."""

    def run(batches):
        pair = once_per_process(f"pair {byte_level} {pieces}", lambda: Pair(byte_level, pieces))
        block = _Block()
        for batch in batches:
            for part in _chunks(batch):
                doc_ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                yield from _align(block, pair, doc_ids, pair.encode(texts))
        if block.docs or block.size:
            yield block.flush()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, links, best``: how many links of the corpus hold an id pair linked, and
    whether that is its B id's highest count. A pair is ``a << 32 | b``."""
    asked = blocks.select(F.inline(F.arrays_zip("pairs", "pair_n")))
    counts = asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_n").alias("links"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    top = counts.groupBy(F.col("b").alias("top_b")).agg(F.max("links").alias("top"))
    return counts.join(top, F.col("b") == F.col("top_b")).selectExpr("pair", "links", "links = top AS best")


def alignment_report(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row for each document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    n_shared, groups_sha256``.

    n_best are the links whose id pair has its B id's highest corpus-wide count, ties
    included; count_sum adds up those counts over the links; n_shared are the links of
    tokens in one group. Texts without tokens have zeros and an empty digest.
    """
    blocks = stored(aligned_blocks(documents, byte_level, pieces), "alignment-blocks")
    counts = stored(pair_counts(blocks), "alignment-pairs")
    asked = blocks.select(F.col("block").alias("to_block"), F.posexplode("pairs").alias("at", "asked"))
    answers = asked.join(counts, F.col("asked") == F.col("pair")).select("to_block", "at", "links", "best")
    payload = blocks.drop("pairs", "pair_n")

    def answer(own, found):
        import numpy as np
        import pyarrow as pa

        row = own.to_pylist()[0]
        links = np.zeros(found.num_rows, dtype=np.int64)
        best = np.zeros(found.num_rows, dtype=np.int64)
        at = found.column("at").to_numpy()
        links[at] = found.column("links").to_numpy()
        best[at] = found.column("best").to_numpy(zero_copy_only=False)
        owners = unpacked(row["owners"][8:]) + int.from_bytes(row["owners"][:8], "little")
        sizes, step, times = (unpacked(row[c]) for c in ("sizes", "entries", "times"))
        ends = np.cumsum(sizes)
        # Places are stored as steps inside a document.
        at = np.cumsum(step)
        at -= np.repeat(np.concatenate([[0], at[ends[:-1] - 1]]) if len(ends) else at, sizes)
        edge = ends - sizes
        best_sum = np.add.reduceat(best[at] * times, edge) if len(at) else edge
        links_sum = np.add.reduceat(links[at] * times, edge) if len(at) else edge
        # A document may have entries here and its row in a later block.
        place = {n: k for k, n in enumerate(row["number"])}
        extra = [n for n in owners.tolist() if n not in place]
        place |= {n: len(row["number"]) + k for k, n in enumerate(extra)}
        at = np.array([place[n] for n in owners.tolist()], dtype=np.int64)
        n_best, count_sum = (np.zeros(len(place), dtype=np.int64) for _ in range(2))
        n_best[at], count_sum[at] = best_sum, links_sum
        kinds = dict.fromkeys(DOC_COLUMNS, pa.int64()) | {"groups_sha256": pa.string()}
        doc = {c: pa.array(row[c] + [None] * len(extra), kind) for c, kind in kinds.items()}
        return pa.table({
            "run": pa.array([row["run"]] * len(place), pa.string()), "number": pa.array(row["number"] + extra, pa.int64()),
            **doc, "n_best": n_best, "count_sum": count_sum,
        })

    schema = ("run string, number long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, "
              "groups_sha256 string, n_best long, count_sum long")
    parts = payload.groupBy("block").cogroup(answers.groupBy("to_block")).applyInArrow(answer, schema)
    whole_docs = parts.groupBy("run", "number").agg(
        *[F.max(c).alias(c) for c in DOC_COLUMNS], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return whole_docs.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_shared", "groups_sha256"
    )


def token_links(documents: DataFrame, byte_level: str, pieces: str, shared_groups: bool = False) -> DataFrame:
    """The links themselves: ``doc_id, a, b, a_id, b_id, n_bytes``, a and b being places of
    tokens. With ``shared_groups`` the links of tokens that share a group, n_bytes null."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        pair = once_per_process(f"pair {byte_level} {pieces}", lambda: Pair(byte_level, pieces))
        names = ["doc_id", "a", "b", "a_id", "b_id", "n_bytes"]
        for batch in batches:
            for part in _chunks(batch):
                doc_ids = part.column(0)
                for k, tokens in enumerate(pair.encode(part.column(1).to_pylist())):
                    if tokens is None:
                        continue
                    aligned = Aligned(pair, *tokens)
                    for a, b, n in aligned.shared() if shared_groups else aligned.overlaps():
                        own = doc_ids.take(pa.array(np.full(len(a), k)))
                        size = pa.nulls(len(a), pa.int64()) if shared_groups else pa.array(n)
                        columns = [pa.array(x) for x in (a, b, tokens[0][a], tokens[1][b])]
                        yield pa.RecordBatch.from_arrays([own, *columns, size], names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, a long, b long, a_id long, b_id long, n_bytes long")
