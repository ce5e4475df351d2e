"""Jaccard self-join of documents on word n-grams, by prefix filtering.

A document's set holds its distinct shingles of three words, as 64-bit hashes; equal
sets are one node, known by a hash of the set, so copies are neither joined nor
expanded. Sets link if the intersection is at least 90 % of the union.

1. Frequencies: each document adds one to the cell of each of its shingles; the cells
   of all documents are added up (a fixed number of cells, so their size is bounded). A
   shingle's rank is its cell's count, then its hash: one order for all documents, rare
   shingles first. Shingles that share a cell only make the order less sharp, never a
   link less.
2. Prefixes: a set of n shingles must share one of its first n - ceil(0.9 n) + 1 in that
   order with any partner. Nodes meet at the shingles of their prefixes.
3. Filters: pairs whose lengths differ too much, or for which the places of the common
   shingle leave too few others before and behind it (positional), are dropped where
   they meet. The suffix filter then cuts the hash space at fixed pivots, into more parts
   for larger sets: two sets have at most the smaller count of each part in common, which
   for unrelated ones is about 0.8 of a set.
4. Pairs that are left are verified on the whole sets, once each, and linked nodes become
   groups (``common.near_components``: hubs, not all pairs of a bucket).

Sets are made again from the texts of those nodes that meet another one, instead of
being stored for all.
"""

import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import LOWER, near_components, small, stored

SHINGLE_WORDS = 3
# Documents link if 100 * intersection >= PERCENT * union.
PERCENT = 90
# Cells of the frequency table, and rows that it is summed in.
CELL_BITS, SLICES = 20, 64
# The suffix filter has a power of two of parts, with at most so many shingles each on average.
PART_SHINGLES = 3
# Largest count of a part that a byte holds: a set with a larger one is not filtered by its parts.
MOST_COUNT = 127
# Bytes of a row per node, as counted before a broadcast.
ROW_BYTES = 128
# Hashes that are counted at a time.
COUNTED = 1 << 20
# Odd factors of the words of a shingle, and of a shorter text.
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
SHORT = 0x27D4EB2F165667C5


def shingles(text: str | None, words_each: int = SHINGLE_WORDS):
    """The sorted distinct hashes of a text's shingles; a shorter text is one shingle."""
    import numpy as np
    import xxhash

    words = [] if text is None else text.encode().translate(LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = xxhash.xxh64_intdigest
    each = np.array([hashed(w) for w in words], dtype=np.uint64)
    if len(words) < words_each:
        return _mixed(np.array([xxhash.xxh64_intdigest(each.tobytes(), SHORT)], dtype=np.uint64))
    count = len(words) - words_each + 1
    total = np.zeros(count, dtype=np.uint64)
    for k in range(words_each):
        factor = np.uint64((FACTORS[k % 3] * (2 * k + 1)) & (2 ** 64 - 1))
        total += each[k:k + count] * factor
    return np.unique(_mixed(total))


def _mixed(h):
    """Spreads the bits of sums, one to one."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cells_of(hashes):
    import numpy as np

    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def frequencies(documents: DataFrame, words_each: int = SHINGLE_WORDS):
    """For each cell, in how many documents its shingles occur: an array of 2^CELL_BITS counts."""
    import numpy as np

    each = (1 << CELL_BITS) // SLICES

    def count(batches):
        import pyarrow as pa

        total, waiting, held = np.zeros(1 << CELL_BITS, dtype="<u8"), [], 0
        for batch in batches:
            texts = batch.column(0)
            for k in range(batch.num_rows):
                waiting.append(cells_of(shingles(texts[k].as_py(), words_each)))
                held += len(waiting[-1])
                if held >= COUNTED:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total)).astype("<u8")
                    waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total)).astype("<u8")
        if total.any():
            parts = [zlib.compress(total[k * each:(k + 1) * each].tobytes(), 1) for k in range(SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    def added(batches):
        import pyarrow as pa

        sums: dict = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(zlib.decompress(part.as_py()), dtype="<u8")
                sums[k] = own + sums[k] if k in sums else own
        if sums:
            parts = [zlib.compress(v.tobytes(), 1) for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    counts = documents.select(F.col("text").cast("string")).mapInArrow(count, "slice int, counts binary")
    # Each slice is added up in one task, from one row a task.
    whole = counts.repartition(SLICES, "slice").mapInArrow(added, "slice int, counts binary")
    total = np.zeros(1 << CELL_BITS, dtype="<u8")
    for row in whole.collect():
        total[row.slice * each:(row.slice + 1) * each] = np.frombuffer(zlib.decompress(bytes(row.counts)), dtype="<u8")
    return total


def needed(n: int, percent: int = PERCENT) -> int:
    """The fewest shingles that a set of n shares with any partner."""
    return -(-percent * n // 100)


def part_counts(own):
    """How many of the hashes are in each part of the hash space; a part is two neighbours of the next finer cut."""
    import numpy as np

    bits = max(1, (len(own) // PART_SHINGLES).bit_length())
    return np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def _most_common() -> str:
    """SQL for the sum of the smaller counts of ``a_parts`` and ``b_parts``, at the coarser of their cuts."""
    def folded(own: str, other: str) -> str:
        per = f"size({own}_parts) div size({other}_parts)"
        sums = f"transform(sequence(0, size({other}_parts) - 1), i -> aggregate(slice({own}_parts, i * ({per}) + 1, {per}), 0, (s, v) -> s + v))"
        return f"if(size({own}_parts) > size({other}_parts), {sums}, {own}_parts)"

    return f"aggregate(zip_with({folded('a', 'b')}, {folded('b', 'a')}, (u, v) -> least(u, v)), 0L, (s, v) -> s + v)"


def _unlike(percent: int) -> str:
    """SQL for pairs with too little in common, by ``a_n, a_parts, b_n, b_parts``; false without parts."""
    return f"coalesce({100 + percent} * {_most_common()} < {percent} * (a_n + b_n), false)"


def sets(documents: DataFrame, counts, words_each: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, n, node, prefix, parts`` of every document: the size and hash of
    its set, its rarest shingles in order, and the counts of the hash space's parts, a byte
    each as they go through shuffles with every bucket of a node."""
    kept = documents.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            sizes, nodes, prefixes, parts = [], [], [], []
            texts = batch.column(2)
            for k in range(batch.num_rows):
                own = shingles(texts[k].as_py(), words_each)
                n = len(own)
                sizes.append(n)
                nodes.append(xxhash.xxh64_intdigest(own.tobytes()))
                first = n - needed(n, percent) + 1 if n else 0
                rank = kept.value[cells_of(own)]
                order = np.lexsort((own, rank))[:first]
                prefixes.append(own[order].view(np.int64))
                counts = part_counts(own)
                parts.append(counts.astype(np.int8) if counts.max() <= MOST_COUNT else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(parts, pa.list_(pa.int8())),
            ], ["doc_id", "text_hash", "n", "node", "prefix", "parts"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(
        run, "doc_id long, text_hash long, n long, node long, prefix array<long>, parts array<byte>"
    )


def _whole_sets(documents: DataFrame, nodes: DataFrame, words_each: int) -> DataFrame:
    """``node, shingles`` of the nodes, from one text of each (``node, text_hash``)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        seen: set[int] = set()
        for batch in batches:
            found, own = [], []
            for k, text_hash in enumerate(batch.column(0).to_pylist()):
                if text_hash in seen:
                    continue
                if len(seen) >= COUNTED:
                    seen.clear()
                seen.add(text_hash)
                own.append(shingles(batch.column(1)[k].as_py(), words_each))
                found.append(xxhash.xxh64_intdigest(own[-1].tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64())),
            ], ["node", "shingles"])

    wanted = small(stored(nodes.select(F.col("text_hash").alias("wanted")), "ngrams-wanted"), 16)
    rows = documents.select(F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    texts = rows.join(wanted, F.col("text_hash") == F.col("wanted"), "left_semi")
    whole = texts.mapInArrow(run, "node long, shingles array<long>")
    # Copies of a text were in several tasks.
    return whole.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _linker(documents: DataFrame, distinct: DataFrame, words_each: int, percent: int):
    """Links of pairs: the suffix filter on the counts of parts, then the whole sets of the pairs that pass."""

    def linker(nodes: DataFrame):
        met = nodes.withColumnRenamed("node", "of")
        own = stored(
            distinct.join(met, F.col("node") == F.col("of"), "left_semi").select("node", "text_hash", "n", "parts"), "ngrams-nodes"
        )

        def both(pairs: DataFrame, df: DataFrame) -> DataFrame:
            for by in "ab":
                side = df.select(*[F.col(c).alias(f"{by}_{c}") for c in df.columns])
                pairs = pairs.join(side, F.col(by) == F.col(f"{by}_node")).drop(f"{by}_node")
            return pairs

        def link(pairs: DataFrame) -> DataFrame:
            left = both(pairs, own.drop("text_hash")).where(f"NOT {_unlike(percent)}")
            left = stored(left.select("a", "b"), "ngrams-left")
            ends = left.selectExpr("a AS end").union(left.selectExpr("b")).distinct()
            needed_ = own.join(ends, F.col("node") == F.col("end"), "left_semi")
            sets_ = stored(_whole_sets(documents, needed_, words_each), "ngrams-sets")
            common = "size(array_intersect(a_shingles, b_shingles))"
            union = f"(size(a_shingles) + size(b_shingles) - {common})"
            return both(left, sets_).where(f"100L * {common} >= {percent}L * {union}").select("a", "b")

        return link

    return linker


def _lengths_apart(percent: int) -> str:
    """SQL on two marks ``n << 32 | place``: the lengths allow no link."""
    return f"100 * least(shiftright(x, 32), shiftright(y, 32)) < {percent} * greatest(shiftright(x, 32), shiftright(y, 32))"


def _far(percent: int) -> str:
    """SQL on two marks ``n << 32 | place``: the lengths or the places allow no link."""
    n = {v: f"shiftright({v}, 32)" for v in "xy"}
    at = {v: f"({v} & 4294967295L)" for v in "xy"}
    before = f"least({at['x']}, {at['y']})"
    behind = f"least({n['x']} - {at['x']}, {n['y']} - {at['y']})"
    places = f"{100 + percent} * ({before} + {behind}) < {percent} * ({n['x']} + {n['y']})"
    return f"({_lengths_apart(percent)} OR {places})"


def ngram_groups(documents: DataFrame, words_each: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document: components of the links.

    component_id is the smallest doc_id of the component, null if all are null. A document
    without words (null, empty, white space) has no shingles and is linked with nothing,
    copies of itself included. Repeated rows are each answered; other columns are ignored.
    """
    counts = frequencies(documents, words_each)
    rows = stored(sets(documents, counts, words_each, percent).withColumn("row", F.monotonically_increasing_id()), "ngrams-rows")
    known = stored(
        rows.where("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"), F.max("n").alias("n"), F.min("row").alias("of_row"),
        ), "ngrams-distinct",
    )
    # Prefixes and parts are read from one row of each node instead of being written again.
    distinct = rows.select("row", "prefix", "parts").join(small(known, ROW_BYTES), F.col("row") == F.col("of_row")).select(
        "node", "text_hash", "n", "prefix", "parts"
    )
    buckets = distinct.select("node", "n", F.posexplode("prefix").alias("place", "bucket")).selectExpr(
        "bucket", "node", "shiftleft(n, 32) | place AS mark"
    )
    groups = near_components(
        buckets, _linker(documents, distinct, words_each, percent), _far(percent), "ngrams",
        details=distinct.selectExpr("node", "struct(n, parts) AS detail"), no_link=re.sub(r"\b([ab])_", lambda m: {"a": "x.", "b": "y."}[m[1]], _unlike(percent)),
        beyond=f"({_lengths_apart(percent)})",
    )
    member = known.select("node", "first_id").join(
        groups.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left"
    ).select("node", "first_id", F.coalesce("root", "node").alias("root"))
    least = member.groupBy("root", F.pmod("root", F.lit(7)).alias("part")).agg(
        F.min("first_id").alias("component_id")
    ).select(F.col("root").alias("of_root"), "component_id")
    labels = stored(
        member.join(least, F.col("root") == F.col("of_root")).select(F.col("node").alias("of_node"), "component_id"),
        "ngrams-labels",
    )
    # Documents without words all have the node of the empty set, which has no label.
    return rows.join(labels, F.col("node") == F.col("of_node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
