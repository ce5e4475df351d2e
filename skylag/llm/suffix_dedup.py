"""Removal of repeated byte strings by suffix arrays.

Every byte covered by a string of ``width`` bytes that also starts anywhere else goes.

1. Cut. The windows of a text (strings of ``width`` bytes) are dealt into pieces: a
   piece is a run of windows that have the same smallest ``ANCHOR``-byte gram, by hash.
   Equal windows have the same gram, at the same place. So equal windows lie in pieces
   with the same gram hash, and all others need not meet.
2. Pieces that are equal are counted, in each task first. All windows of a piece that
   occurs twice are repeats; a copy costs a row of numbers and no text.
3. Where a gram has several different pieces, one of each kind is sent with its text to
   a shard, if it may share a window with another by the bytes beside the gram. The shard's suffix array is made by induced sorting: suffixes are
   classified, leftmost-smaller substrings sorted recursively, the array induced from
   them, and the common prefixes computed in text order. A window is a repeat if its
   suffix shares ``width`` bytes with a neighbour in the array.
4. A gram with more than ``CROWD`` different pieces (the edge of a passage that a third
   of the documents hold) is cut again, into pieces of one window each, which are
   counted as in 2: such pieces are equal or unrelated.
5. Marks are gathered per document, and the bytes removed there.
"""

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import stored

WIDTH = 200
ANCHOR = 40
# Different pieces of one gram that go to one shard, and bytes that a shard aims at.
CROWD = 2000
SHARD_BYTES = 1 << 20
# Places of two substrings that are compared for all substrings at once.
NAMED_PLACES = 64
# Bytes of a text that are cut at a time, and bits that number places in them.
CHUNK = 1 << 22
PLACE_BITS = 24

KEY = ["k0", "k1"]
PIECES_SCHEMA = "k0 long, k1 long, gram long, piece long, a long, n int, at int, left int, right int"


def keyed(documents: DataFrame) -> DataFrame:
    """``k0, k1, doc_id, text``: the key is the id and a hash of the text, a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k0"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("k1"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
    )


def rolling(data, width: int):
    """Hashes of all strings of ``width`` bytes, by doubling."""
    import numpy as np

    if len(data) < width:
        return np.zeros(0, dtype=np.uint64)
    level, factor, size = data.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    total, at, n = None, 0, len(data) - width + 1
    while True:
        if width & size:
            part = level[at:at + n]
            total = part.copy() if total is None else total * factor + part
            at += size
        if 2 * size > width:
            break
        level = level[:-size] * factor + level[size:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        size *= 2
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def smallest(values, width: int):
    """Minima of all runs of ``width`` values."""
    import numpy as np

    level, size = values, 1
    while 2 * size <= width:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    n = len(values) - width + 1
    return np.minimum(level[:n], level[width - size:width - size + n])


def cut(data: bytes, width: int, anchor: int):
    """The pieces of a text: ``(gram hash, piece hash, first window, windows, place of the
    gram in the piece, left hash, right hash)``.

    A window that starts ``half`` bytes before the gram or earlier holds those bytes and
    the gram, any other the gram and ``width - half`` bytes from there on. The left and
    the right hash are of these strings, 0 if the piece has no such window: pieces that
    share neither share no window.
    """
    import numpy as np
    import xxhash

    found = []
    hashed, short = xxhash.xxh64_intdigest, xxhash.xxh32_intdigest
    half = (width - anchor) // 2
    for gram, at, edges in anchors(data, width, anchor):
        for g, p, a, b in zip(gram.tolist(), at.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            piece = hashed(data[a:b + width - 1], p - a)
            left = (short(data[p - half:p + anchor]) >> 2) + 1 if a <= p - half else 0
            right = (short(data[p:p + width - half]) >> 2) + 1 if b - 1 > p - half else 0
            found.append((g, piece - (1 << 64) if piece >> 63 else piece, a, b - a, p - a, left, right))
    return found


def anchors(data: bytes, width: int, anchor: int):
    """For each stretch of a text: the gram hashes of its pieces, the places of the grams,
    and the first windows of the pieces with the end behind them."""
    import numpy as np

    low = np.uint64((1 << PLACE_BITS) - 1)
    for begin in range(0, len(data) - width + 1, CHUNK):
        part = np.frombuffer(data[begin:begin + CHUNK + width - 1], dtype=np.uint8)
        grams = rolling(part, anchor)
        place = smallest((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width - anchor + 1) & low
        edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
        at = place[edges[:-1]].astype(np.int64)
        yield grams[at].view(np.int64), at + begin, edges + begin


def gram_rows(rows: DataFrame, width: int, anchor: int) -> DataFrame:
    """The gram hash of every piece."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(0)
            for k in range(batch.num_rows):
                for gram, _, _ in anchors(texts[k].as_py().encode(), width, anchor):
                    yield pa.RecordBatch.from_arrays([pa.array(gram)], ["gram"])

    return rows.select("text").mapInArrow(run, "gram long")


def pieces(rows: DataFrame, width: int, anchor: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        types = [pa.int64()] * 5 + [pa.int32()] * 4
        names = ["k0", "k1", "gram", "piece", "a", "n", "at", "left", "right"]
        for batch in batches:
            k0, k1, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            made = []
            for k in range(batch.num_rows):
                made += [(k0[k], k1[k], *p) for p in cut(texts[k].as_py().encode(), width, anchor)]
                if len(made) > 50_000 or k == batch.num_rows - 1:
                    columns = list(zip(*made)) or [[]] * 9
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                    made = []

    return rows.select(*KEY, "text").mapInArrow(run, PIECES_SCHEMA)


# ---- suffix array of a shard


def named(text, starts, stops):
    """Numbers of sorted substrings ``text[start:stop]``, equal ones alike."""
    import numpy as np

    length = stops - starts
    differs = np.ones(len(starts), dtype=bool)
    differs[1:] = length[1:] != length[:-1]
    # Neighbours of one length are compared a place at a time, the few that are alike for long at once.
    alike, place = np.flatnonzero(~differs), 0
    while len(alike) and place < NAMED_PLACES:
        alike = alike[length[alike] > place]
        other = text[starts[alike] + place] != text[starts[alike - 1] + place]
        differs[alike[other]] = True
        alike = alike[~other]
        place += 1
    for k in alike[length[alike] > place].tolist():
        one, two, n = starts[k], starts[k - 1], length[k]
        differs[k] = not np.array_equal(text[one + place:one + n], text[two + place:two + n])
    return np.cumsum(differs) - 1


def induced_order(s, size: int):
    """Suffix array of numbers below ``size`` that end with their only 0."""
    import numpy as np

    n = len(s)
    text = np.asarray(s, dtype=np.int64)
    if n < 3:
        return np.array(sorted(range(n), key=lambda k: text[k:].tolist()), dtype=np.int64)
    # Classify: a suffix is smaller than the next if its first different number is.
    step = np.sign(np.diff(text))
    known = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    smaller = np.ones(n, dtype=bool)
    smaller[:-1] = step[np.minimum(following, n - 2)] > 0
    smaller[n - 2] = step[-1] > 0
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    heads = ends - counts
    # What stands before each suffix, if it is induced as a larger or a smaller one; else -1.
    before = np.concatenate([[-1], text[:-1]])
    is_larger = np.concatenate([[False], ~smaller[:-1]])
    is_smaller = np.concatenate([[False], smaller[:-1]])
    larger_kind = np.where(is_larger, before, -1)
    smaller_kind = np.where(is_smaller, before, -1)

    def induce_buckets(seeds):
        """The same order, a bucket at a time: what a bucket induces is dealt to the others
        in one stable sort, and what it induces into itself follows in waves."""
        seeds = np.asarray(seeds, dtype=np.int64)
        by = np.argsort(text[seeds], kind="stable")
        edges = np.searchsorted(text[seeds][by], np.arange(size + 1))
        seeded = [seeds[by[a:b]] for a, b in zip(edges[:-1], edges[1:])]
        larger, waiting = [None] * size, [[] for _ in range(size)]
        nothing = np.zeros(0, dtype=np.int64)

        def pass_on(found, kind, at):
            """Deal the induced suffixes to other buckets; those of bucket ``at`` come back."""
            prior = kind[found]
            found, prior = found[prior >= 0] - 1, prior[prior >= 0]
            own = prior == at
            others, to = found[~own], prior[~own]
            if len(others):
                by_ = np.argsort(to.astype(np.uint16), kind="stable")
                others, to = others[by_], to[by_]
                cuts = np.flatnonzero(np.diff(to)) + 1
                for c, part in zip(to[np.concatenate([[0], cuts])].tolist(), np.split(others, cuts)):
                    waiting[c].append(part)
            return found[own]

        for c in range(size):
            wave = np.concatenate([nothing, *waiting[c]])
            waves = []
            while len(wave):
                waves.append(wave)
                wave = pass_on(wave, larger_kind, c)
            larger[c] = np.concatenate([nothing, *waves])
            # The seeds stand behind the larger ones of their bucket.
            pass_on(seeded[c], larger_kind, c)
        waiting = [[] for _ in range(size)]
        parts = [None] * size
        for c in range(size - 1, -1, -1):
            # From the end: the smaller ones first, in reverse, then the larger ones.
            wave = np.concatenate([nothing, *waiting[c]])
            waves = []
            while len(wave):
                waves.append(wave)
                wave = pass_on(wave, smaller_kind, c)
            backwards = np.concatenate([nothing, *waves])
            pass_on(larger[c][::-1], smaller_kind, c)
            parts[c] = np.concatenate([larger[c], backwards[::-1]])
        parts[0] = np.array([n - 1])
        return np.concatenate(parts)

    def induce(seeds):
        if size <= 512 and n > 4 * size:
            return induce_buckets(seeds)
        larger_before, smaller_before = larger_kind.tolist(), smaller_kind.tolist()
        # The seeds stand at the ends of their buckets, in the order given.
        seeds = np.asarray(seeds, dtype=np.int64)
        by = np.argsort(text[seeds], kind="stable")
        own = text[seeds][by]
        order = np.full(n, -1)
        order[ends[own] - np.searchsorted(own, own, side="right") + np.arange(len(own))] = seeds[by]
        order = order.tolist()
        head = heads.tolist()
        for k in order:
            if k >= 0:
                c = larger_before[k]
                if c >= 0:
                    order[head[c]] = k - 1
                    head[c] += 1
        tail = ends.tolist()
        for at in range(n - 1, -1, -1):
            k = order[at]
            if k >= 0:
                c = smaller_before[k]
                if c >= 0:
                    tail[c] -= 1
                    order[tail[c]] = k - 1
        return np.array(order)

    order = induce(leftmost)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    ranked = order[is_leftmost[order]]
    # Name the substrings from one leftmost-smaller place to the next, equal ones alike.
    stop = np.full(n, n - 1)
    stop[leftmost[:-1]] = leftmost[1:]
    names = np.zeros(n, dtype=np.int64)
    names[ranked] = named(text, ranked, stop[ranked] + 1)
    count = int(names[ranked[-1]]) + 1
    return induce(ranked if count == len(leftmost) else leftmost[induced_order(names[leftmost], count)])


def common_prefixes(text: bytes, order):
    """For each suffix in text order, the bytes it shares with the one before it in the array.

    The length falls by at most one from a suffix to the next in the text, and by just
    one where the bytes before both are equal; only the other places are compared.
    """
    import numpy as np

    n, order = len(order), np.asarray(order)
    ahead = np.full(n, -1)
    ahead[order[1:]] = order[:-1]
    letters = np.frombuffer(text, dtype=np.uint8)
    place = np.arange(n)
    # Where both are preceded by one byte, the length is that of the place before less one.
    fresh = (place == 0) | (ahead <= 0)
    fresh[1:] |= letters[place[1:] - 1] != letters[np.maximum(ahead[1:] - 1, 0)]
    fresh[1:] |= ahead[:-1] < 0
    shared = np.zeros(n, dtype=np.int64)
    at = np.flatnonzero(fresh & (ahead >= 0))
    # Eight bytes at a time, for all places at once; the first different byte is the lowest.
    padded = text + bytes(16)
    eight = np.ndarray((n + 8,), dtype="<u8", buffer=padded, strides=(1,)).copy()
    one, two, end = at, ahead[at], n - 1 - np.maximum(at, ahead[at])
    length, active = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
    while len(active):
        done = length[active]
        differ = eight[one[active] + done] ^ eight[two[active] + done]
        low = differ & (~differ + np.uint64(1))
        more = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        length[active] = np.minimum(done + more, end[active])
        active = active[(differ == 0) & (done + 8 < end[active])]
    shared[at] = length
    last = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(shared[last] - (place - last), 0)


def repeated_windows(texts: list[bytes], width: int):
    """For each text, whether each of its windows occurs more than once in all of them.

    Texts are joined by a byte of their own; a match must end before the joint.
    """
    import numpy as np

    joined = b"\0".join(texts) + b"\0"
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    flat = np.concatenate([np.frombuffer(joined, dtype=np.uint8).astype(np.int64) + 2, [0]])
    flat[begins + lengths] = 1
    order = induced_order(flat, 258)
    left = np.repeat(begins + lengths, lengths + 1) - np.arange(len(flat) - 1)
    # Prefixes are measured up to the joint of either side.
    shared = common_prefixes(joined + b"\0", order)[:-1]
    rank = np.array(order)
    full = np.concatenate([shared, [0]])
    left = np.concatenate([left, [0]])
    before = np.concatenate([[0], rank[:-1]])
    match = np.minimum(full[rank], np.minimum(left[rank], left[before])) >= width
    twice = np.zeros(len(rank), dtype=bool)
    twice[rank[1:][match[1:]]] = True
    twice[rank[:-1][match[1:]]] = True
    return [twice[b:b + max(0, n - width + 1)] for b, n in zip(begins.tolist(), lengths.tolist())]


def runs(flags) -> list[tuple[int, int]]:
    import numpy as np

    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()))


# ---- the whole job


def _with_text(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The wanted pieces with their bytes, fetched from the documents by key."""
    grouped = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("gram", "piece", "a", "n", "crowd", "copies")).alias("own"))
    # Rows with one key are copies; one of them holds the text for all.
    joined = rows.select(*KEY, "text").join(
        grouped.withColumnsRenamed({"k0": "w0", "k1": "w1"}), F.expr("k0 = w0 AND k1 = w1")
    ).select(*KEY, "text", "own")

    def run(batches):
        import pyarrow as pa

        names = ["k0", "k1", "gram", "piece", "a", "n", "crowd", "copies", "bytes"]
        types = [pa.int64()] * 5 + [pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                k0, k1, text, own = (batch.column(c)[k].as_py() for c in range(4))
                data, made = text.encode(), []
                for w in own:
                    made.append((k0, k1, w["gram"], w["piece"], w["a"], w["n"], w["crowd"], w["copies"],
                                 data[w["a"]:w["a"] + w["n"] + width - 1]))
                for at in range(0, len(made), 20_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*made[at:at + 20_000]), types)], names)

    return joined.mapInArrow(
        run, "k0 long, k1 long, gram long, piece long, a long, n int, crowd boolean, copies long, bytes binary"
    )


def _shard_marks(texts: DataFrame, width: int) -> DataFrame:
    """Marks ``k0, k1, a, n`` from the suffix arrays of the shards."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))

    def run(table):
        import pyarrow as pa

        rows = table.to_pylist()
        marks = []
        for row, flags in zip(rows, repeated_windows([r["bytes"] for r in rows], width)):
            if row["copies"] == 1:
                marks += [(row["k0"], row["k1"], row["a"] + at, n) for at, n in runs(flags)]
        columns = list(zip(*marks)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.int32()])], names=["k0", "k1", "a", "n"])

    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, "k0 long, k1 long, a long, n int")


def _window_marks(texts: DataFrame, width: int) -> DataFrame:
    """Marks of crowded grams: pieces of one window, counted by a hash of 128 bits."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for k in range(batch.num_rows):
                k0, k1, a, n, copies, data = (batch.column(c)[k].as_py() for c in range(6))
                hashes = [xxhash.xxh3_128_intdigest(data[at:at + width]) for at in range(n)]
                low = np.array([h & (1 << 64) - 1 for h in hashes], dtype=np.uint64).view(np.int64)
                high = np.array([h >> 64 for h in hashes], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k0] * n, pa.int64()), pa.array([k1] * n, pa.int64()),
                    pa.array(np.arange(a, a + n), pa.int64()), pa.array(high), pa.array(low),
                    pa.array([copies] * n, pa.int64()),
                ], ["k0", "k1", "a", "high", "low", "copies"])

    single = stored(texts.select(*KEY, "a", "n", "copies", "bytes").mapInArrow(
        run, "k0 long, k1 long, a long, high long, low long, copies long"), "suffix-windows")
    twice = single.groupBy("high", "low", F.pmod("low", F.lit(7)).alias("part")).agg(F.sum("copies").alias("times")).where(
        "times > 1").select(F.col("high").alias("th"), F.col("low").alias("tl"))
    found = single.where("copies = 1").join(twice, F.expr("high = th AND low = tl"), "left_semi")
    return found.select(*KEY, "a", F.lit(1).alias("n"))


def _comparable(kinds: DataFrame, width: int, anchor: int) -> DataFrame:
    """The pieces that share their left or right hash with another of their gram, less the
    windows of a side that is not shared."""
    half = (width - anchor) // 2
    for side in ("left", "right"):
        more = kinds.where(f"{side} <> 0").groupBy("gram", side).agg(F.count("*").alias("m")).where("m > 1").select(
            F.col("gram").alias(f"{side}_of"), F.col(side).alias(f"{side}_hash"), F.lit(True).alias(f"{side}_shared")
        )
        kinds = kinds.join(more, F.expr(f"gram = {side}_of AND {side} = {side}_hash"), "left")
    # Windows up to this one start early enough to hold the left string.
    early = f"greatest(0, least(n, at - {half} + 1))"
    return kinds.where("left_shared OR right_shared").selectExpr(
        "first.k0", "first.k1", "gram", "piece", f"first.a + if(left_shared, 0, {early}) AS a",
        f"cast(if(right_shared, n, {early}) - if(left_shared, 0, {early}) AS int) AS n",
        f"kinds > {CROWD} AS crowd", "copies",
    ).where("n > 0")


def repeat_marks(rows: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``k0, k1, a, n``: runs of n windows from byte a that occur more than once."""
    grams = gram_rows(rows, width, anchor).groupBy("gram").agg(F.count("*").alias("total"))
    grams = stored(grams.where("total > 1").select(F.col("gram").alias("of")), "suffix-grams")
    # The counts are written before they are joined, so both sides are dealt anew and a hot gram can be split.
    shared = stored(pieces(rows, width, anchor).join(grams, F.col("gram") == F.col("of")).drop("of"), "suffix-pieces")
    kinds = stored(shared.groupBy("gram", "piece").agg(
        F.count("*").alias("copies"), F.min(F.struct("k0", "k1", "a")).alias("first"),
        *[F.first(c).alias(c) for c in ("n", "at", "left", "right")],
    ), "suffix-kinds")
    twice = kinds.where("copies > 1").select(F.col("gram").alias("g"), F.col("piece").alias("p"))
    whole = shared.join(twice, F.expr("gram = g AND piece = p"), "left_semi").select(*KEY, "a", "n")
    several = kinds.groupBy("gram", F.pmod("gram", F.lit(7)).alias("part")).agg(F.count("*").alias("kinds")).where(
        "kinds > 1").select(F.col("gram").alias("of"), "kinds")
    wanted = _comparable(kinds.join(several, F.col("gram") == F.col("of")).drop("of"), width, anchor)
    texts = stored(_with_text(rows, wanted, width), "suffix-texts").dropDuplicates(["k0", "k1", "a"])
    marks = whole.unionByName(_shard_marks(texts.where("NOT crowd"), width)).unionByName(
        _window_marks(texts.where("crowd"), width)
    )
    return stored(marks, "suffix-marks")


def remove_repeats(documents: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    ``spans`` are the maximal removed runs as byte places. Rows that repeat, ids
    included, are documents of their own, so copies of each other. A text shorter than
    ``width`` loses nothing; a null text is empty. Other columns are ignored.
    """
    rows = keyed(documents)
    marks = repeat_marks(rows, width, anchor).groupBy(*KEY).agg(F.collect_list(F.struct("a", "n")).alias("marks"))
    joined = rows.join(
        marks.withColumnsRenamed({"k0": "m0", "k1": "m1"}), F.expr("k0 = m0 AND k1 = m1"), "left"
    ).select("doc_id", "text", "marks")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            made = []
            for k in range(batch.num_rows):
                doc_id, text, marks = (batch.column(c)[k].as_py() for c in range(3))
                data = text.encode()
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                for m in marks or []:
                    edge[m["a"]] += 1
                    edge[m["a"] + m["n"] + width - 1] -= 1
                gone = np.cumsum(edge)[:len(data)] > 0
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                own = [{"start": a, "stop": a + n} for a, n in runs(gone)]
                made.append((doc_id, len(data), len(data) - len(kept), len(own), hashlib.sha256(kept).hexdigest(), own))
            columns = list(zip(*made)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string(), span]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,stop:long>>"
    )
