"""Benchmark decontamination by suffix arrays over the training text.

Words are numbered by the vocabulary of the benchmark; every other word is a break.
A shard (a bounded run of documents) gets a suffix array over those of its words that
stand in a run long enough to hold a window, sorted by prefix doubling. Every
benchmark suffix is then searched in it by bisection, all suffixes at once: the
result is the range of training suffixes that share a whole window with it
(``contaminated_words``), or its neighbours, and with them the longest verbatim match
and its places (``longest_matches``). Shards need no shuffle, and the benchmark is
broadcast in blocks of bounded size.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import stored

WINDOW = 10
# Benchmark text that one pass over the documents takes, in bytes.
BLOCK_BYTES = 16 << 20
# Words of one shard; a longer document is a shard by itself.
SHARD_WORDS = 1_000_000
# Bytes that are no part of a word become spaces, A-Z lower case.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

HITS_SCHEMA = "doc_id long, row_hash long, n_words long, hits array<struct<a:int,b:int>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(FOLD).split()


class TestSuffixes:
    """The windows of a block of benchmark items as word numbers."""

    def __init__(self, items: list[tuple], window: int):
        import numpy as np

        self.number: dict[bytes, int] = {}
        texts, self.windows = [], {}
        for item, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words_of(text))
            if not ids:
                continue
            texts.append(ids)
            width = min(window, len(ids))
            for at in range(len(ids) - width + 1):
                self.windows.setdefault(ids[at:at + width], set()).add(str(item))
        self.shortest = min(map(len, self.windows), default=0)
        # Test suffixes that start a window, by window length; equal ones are searched once.
        self.by_length = {}
        for key in self.windows:
            self.by_length.setdefault(len(key), []).append(key)
        self.by_length = {n: np.array(sorted(keys), dtype=np.int64) for n, keys in sorted(self.by_length.items())}


def suffix_array(ids, starts, depth: int):
    """The given suffixes of ``ids``, sorted by their first ``depth`` numbers or more.

    Prefix doubling: ranks of 1, 2, 4 .. numbers. ``ids`` ends with a 0, and 0 is a
    break: suffixes are in order as far as the first break, which is all that a key
    without breaks can see.
    """
    import numpy as np

    n = len(ids)
    rank, step = ids.astype(np.int64), 1
    # A text shorter than the depth is ranked by all its numbers when the step reaches its length.
    while step < min(depth, n):
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + ahead
        key[rank == 0] = 0
        _, rank = np.unique(key, return_inverse=True)
        step *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def bisect(ids, suffixes, keys):
    """For every row of ``keys`` the range of sorted suffixes that begin with it."""
    import numpy as np

    width = keys.shape[1]

    def edge(after: bool):
        low, high = np.zeros(len(keys), dtype=np.int64), np.full(len(keys), len(suffixes), dtype=np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high) // 2
            at = suffixes[np.minimum(mid, len(suffixes) - 1)]
            sign = np.zeros(len(keys), dtype=np.int8)
            for k in range(width):
                there = ids[np.minimum(at + k, len(ids) - 1)]
                sign = np.where(sign == 0, np.sign(there - keys[:, k]), sign)
            right = open_ & ((sign < 0) | (after & (sign == 0)))
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)

    return edge(False), edge(True)


def shard_matches(tests: TestSuffixes, docs: list[list[bytes]]):
    """Per document of a shard: merged hit spans ``(first word, word behind)`` and items."""
    import numpy as np

    empty = [([], set()) for _ in docs]
    if not tests.windows or not docs:
        return empty
    get = tests.number.get
    parts, first, at = [], [], 0
    for words in docs:
        first.append(at)
        parts.append(np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words)))
        parts.append(np.zeros(1, dtype=np.int64))
        at += len(words) + 1
    ids = np.concatenate(parts)
    # Only runs of benchmark words that can hold a window; the rest would be sorted in vain.
    breaks = np.flatnonzero(ids == 0)
    begins = np.concatenate([[0], breaks[:-1] + 1])
    long_ = breaks - begins >= tests.shortest
    if not long_.any():
        return empty
    lengths = breaks[long_] - begins[long_] + 1
    offset = np.concatenate([[0], np.cumsum(lengths)])
    origin = np.repeat(begins[long_] - offset[:-1], lengths) + np.arange(offset[-1])
    text = ids[origin]
    starts = np.flatnonzero(text != 0)
    suffixes = suffix_array(text, starts, max(tests.by_length))
    spans, found = [], {}
    docs_at = np.array(first)
    for width, keys in tests.by_length.items():
        low, high = bisect(text, suffixes, keys)
        for key in np.flatnonzero(high > low):
            items = tests.windows[tuple(keys[key].tolist())]
            where = origin[suffixes[low[key]:high[key]]]
            owner = np.searchsorted(docs_at, where, side="right") - 1
            spans.append(np.stack([owner, where - docs_at[owner], where - docs_at[owner] + width], axis=1))
            for doc in np.unique(owner).tolist():
                found.setdefault(doc, set()).update(items)
    if not spans:
        return empty
    spans = np.concatenate(spans)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    result = empty
    for doc, a, b in spans.tolist():
        own = result[doc][0]
        if own and a <= own[-1][1]:
            own[-1][1] = max(own[-1][1], b)
        else:
            own.append([a, b])
    return [(own, found.get(k, set())) for k, (own, _) in enumerate(result)]


def _search(documents: DataFrame, items: list[tuple], window: int, shard_words: int) -> DataFrame:
    """One pass over the documents with one block of the benchmark."""
    shared = documents.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        import pyarrow as pa

        tests = TestSuffixes(shared.value, window)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            hashes = batch.column(2)
            shard, size, begin = [], 0, 0

            def flush(upto):
                rows = shard_matches(tests, shard)
                return pa.RecordBatch.from_arrays([
                    pa.array(ids[begin:upto], pa.int64()), hashes.slice(begin, upto - begin),
                    pa.array([len(w) for w in shard], pa.int64()),
                    pa.array([[{"a": a, "b": b} for a, b in spans] for spans, _ in rows],
                             pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                    pa.array([sorted(items) for _, items in rows], pa.list_(pa.string())),
                ], ["doc_id", "row_hash", "n_words", "hits", "items"])

            for k in range(batch.num_rows):
                shard.append(words_of(texts[k].as_py()))
                size += len(shard[-1])
                if size >= shard_words:
                    yield flush(k + 1)
                    shard, size, begin = [], 0, k + 1
            if shard:
                yield flush(batch.num_rows)

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_hash")
    )
    return rows.mapInArrow(search, HITS_SCHEMA)


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark as lists of bounded size, read one after the other."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        n = len(row[1]) if row[1] else 0
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    yield block


def contaminated_words(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per document: ``doc_id, row_hash, n_words, hits, items``.

    ``hits`` are the maximal spans of words inside occurrences of a window, ``items``
    the sorted ids of the items with such a window. Windows are ``window`` consecutive
    words of an item; a shorter item is one window, one without words has none. A null
    text has no words; a null item_id counts as the text 'None'. Rows that repeat are
    each answered. A benchmark larger than ``block_bytes`` is searched in blocks, whose
    results are joined per row.
    """
    passes = [_search(documents, block, window, shard_words) for block in item_blocks(benchmark, block_bytes)]
    if len(passes) == 1:
        return passes[0]
    rows = passes[0]
    for more in passes[1:]:
        rows = rows.unionByName(more)
    # Repeated rows hold equal spans, so one of them stands for all, with its number.
    merged = rows.groupBy("doc_id", "row_hash").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.count("*").alias("copies"),
    )
    join = """aggregate(array_sort(hits), cast(array() AS array<struct<a:int,b:int>>), (done, h) ->
        CASE WHEN size(done) > 0 AND h.a <= element_at(done, -1).b THEN
            concat(slice(done, 1, size(done) - 1),
                   array(struct(element_at(done, -1).a AS a, greatest(element_at(done, -1).b, h.b) AS b)))
        ELSE concat(done, array(h)) END)"""
    return merged.withColumn("hits", F.expr(join)).withColumn(
        "copy", F.expr(f"explode(sequence(1L, copies div {len(passes)}))")
    ).drop("copy", "copies")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, with all their columns.

    The affected documents are few, and a document's result is joined by its id and
    text, so that rows which share an id are told apart.
    """
    name = "decontam_key"
    bad = contaminated_words(documents, benchmark, window).where("size(hits) > 0")
    bad = stored(bad.select(F.col("doc_id").alias("bad_id"), F.col("row_hash").alias("bad_hash")).distinct(), name)
    # The row as one column, so that none of its names can clash.
    rows = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_hash")
    )
    same = F.col("row_id").eqNullSafe(F.col("bad_id")) & (F.col("row_hash") == F.col("bad_hash"))
    return rows.join(bad, same, "left_anti").select("row.*")


def _common(text, at, item, places, limit: int):
    """For each pair of places the number of equal words of the two arrays before a break or the end."""
    import numpy as np

    length = np.zeros(len(at), dtype=np.int64)
    active = np.arange(len(at))
    for k in range(limit):
        there, own = at[active] + k, places[active] + k
        inside = (there < len(text)) & (own < len(item))
        same = inside.copy()
        same[inside] = (text[there[inside]] == item[own[inside]]) & (text[there[inside]] != 0)
        active = active[same]
        if not len(active):
            break
        length[active] += 1
    return length


def shard_longest(items: list[tuple[str, list[int]]], number: dict[bytes, int], docs: list[list[bytes]], window: int):
    """For each item its longest match with the shard, as ``item, length, place in item, document, place in document``.

    Every suffix of an item is put by bisection where it belongs among the shard's sorted
    suffixes; its longest match is with one of the two neighbours. The suffixes that share
    it are one range, of which the first place is taken.
    """
    import numpy as np

    parts, first, at = [], [], 0
    for words in docs:
        first.append(at)
        parts.append(np.fromiter((number.get(w, 0) for w in words), dtype=np.int64, count=len(words)))
        parts.append(np.zeros(1, dtype=np.int64))
        at += len(words) + 1
    text = np.concatenate(parts) if parts else np.zeros(1, dtype=np.int64)
    starts, docs_at = np.flatnonzero(text != 0), np.array(first)
    longest = max((len(own) for _, own in items), default=0)
    if not len(starts) or not longest:
        return
    suffixes = suffix_array(text, starts, longest)
    for name, own in items:
        if not own:
            continue
        item = np.array(own, dtype=np.int64)
        places = np.arange(len(item))
        low, high = np.zeros(len(item), dtype=np.int64), np.full(len(item), len(suffixes), dtype=np.int64)
        while (low < high).any():
            mid = np.minimum((low + high) // 2, len(suffixes) - 1)
            there = suffixes[mid]
            same = _common(text, there, item, places, longest)
            ended = places + same >= len(item)
            ahead = text[np.minimum(there + same, len(text) - 1)] < item[np.minimum(places + same, len(item) - 1)]
            right = (low < high) & ~ended & ahead
            high = np.where((low < high) & ~right, mid, high)
            low = np.where(right, mid + 1, low)
        near = [np.clip(low + k, 0, len(suffixes) - 1) for k in (-1, 0)]
        lengths = np.maximum(*[_common(text, suffixes[n], item, places, longest) for n in near])
        best = int(lengths.max())
        if best < min(window, len(item)):
            continue
        place = int(np.argmax(lengths))
        a, b = bisect(text, suffixes, item[None, place:place + best])
        where = suffixes[a[0]:b[0]]
        owner = np.searchsorted(docs_at, where, side="right") - 1
        yield name, best, place, owner, where - docs_at[owner]


def longest_matches(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The longest verbatim match of every item: ``item_id, length, item_place, doc_id, doc_place``.

    Only matches of at least a window count (the whole item, if it is shorter); items
    without one have no row. Of equally long matches the first in the item is taken, then
    the smallest doc_id, null last, then the first place in the document. Places and
    lengths are in words. Items of one item_id are one item, a null one counts as 'None'.
    """
    spark = documents.sparkSession
    found = None
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            import pyarrow as pa

            number: dict[bytes, int] = {}
            items = [(str(i), [number.setdefault(w, len(number) + 1) for w in words_of(t)]) for i, t in shared.value]

            def flush(ids, docs):
                rows = []
                for name, length, place, owner, at in shard_longest(items, number, docs, window):
                    first = min((ids[o] is None, ids[o] or 0, a) for o, a in zip(owner.tolist(), at.tolist()))
                    rows.append((name, -length, place, *first))
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
                names = ["item_id", "minus", "item_place", "no_id", "doc_id", "doc_place"]
                return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

            ids, docs, size = [], [], 0
            for batch in batches:
                for k in range(batch.num_rows):
                    ids.append(batch.column(0)[k].as_py())
                    docs.append(words_of(batch.column(1)[k].as_py()))
                    size += len(docs[-1])
                    if size >= shard_words:
                        yield flush(ids, docs)
                        ids, docs, size = [], [], 0
            if docs:
                yield flush(ids, docs)

        rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            search, "item_id string, minus long, item_place long, no_id boolean, doc_id long, doc_place long"
        )
        found = rows if found is None else found.unionByName(rows)
    best = found.groupBy("item_id").agg(F.min(F.struct("minus", "item_place", "no_id", "doc_id", "doc_place")).alias("b"))
    return best.selectExpr(
        "item_id", "-b.minus AS length", "b.item_place", "if(b.no_id, NULL, b.doc_id) AS doc_id", "b.doc_place"
    )
