"""Fuzzy line dedup in DataFrame functions only.

Lines are normalised (lower case, runs of other characters than letters and digits
as one space) and get a SimHash of 63 bits over their words; long words weigh more, as
they are more characters and tell lines apart better. Equal normalised lines are one kind, known by a hash of 64 bits
and the SimHash. Kinds meet in buckets:

- for every two of the four blocks of the SimHash: hashes that differ in at most two bits
  agree in two blocks at least. Those that meet count up to ``BLOCK_BITS`` bits;
- for the first and for the last words of a line, about half of them each (a number of
  words from a fixed series, so that lines of nearly equal length have the same one): a
  line with words changed, put in or left out in one half has the other as it was, also
  where so few words turn many bits of the SimHash. Here ``END_BITS`` bits may differ.

Kinds that meet within these bits and whose lengths allow it are verified by the edit
similarity of the lines. One occurrence of each connected group of kinds is kept, the
first by document and place.

The votes for the bits of a SimHash are added in lanes: a sum holds one counter for
each of seven bits, and one addition counts a word for all of them.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import near_components, small, spread, stored

BITS = 63
# Bits in which the SimHashes of lines may differ that meet by blocks, and by first or last words.
BLOCK_BITS, END_BITS = 8, 18
# First bit and width of the blocks of a SimHash.
BLOCKS = [(0, 16), (16, 16), (32, 16), (48, 15)]
# Bytes of a row of a table per document or kind, as counted before a broadcast.
ROW_BYTES = 256
# Pairs that may be left before the last step.
MANY_PAIRS = 300_000
# Lines are near copies if at most one character of five is edited. Most differ in far less, which
# is cheaper to see: this number of edits above the difference in length is tried first, then ``MORE_EDITS``.
# Pairs of lines so long (above 80,000 characters) that they may differ in more than ``SPARK_EDITS``
# are left to ``edits_within``, as Spark's function would take minutes for one of them.
EDITED, FEW_EDITS, MORE_EDITS, SPARK_EDITS = 5, 24, 1024, 16_384
# Words of up to three characters have weight 1, others a third of their characters and five; in lines
# with more weight than a lane counts at most 8.
SHORT_WORD, WEIGHT_PLUS, WEIGHT_CHARS, MOST_WEIGHT = 3, 5, 3, 8
# Bits of a lane, lanes of a long, the weight that a lane can count, and words that surely fit.
WIDTH, LANES, WEIGHTS, WORDS = 9, 7, 511, 63
ONES = sum(1 << (WIDTH * lane) for lane in range(LANES))

# Found, not split at what is between: that would try every character of a word as an end.
NORMAL_WORDS = r"regexp_extract_all(lower(line), '[\\p{L}\\p{N}]+', 0)"


def _votes(hash_: str, weight: str) -> list[Column]:
    """Sums of weights for the set bits of hashes: bit ``b`` in sum ``b % 9``, at lane ``b // 9``."""
    return [F.expr(f"sum((shiftrightunsigned({hash_}, {j}) & {ONES}L) * {weight})").alias(f"s{j}") for j in range(WIDTH)]


def _majority() -> str:
    """SQL for the bits set in over half of the weight ``n``, from the sums.

    Adding half the lane's range less the votes needed carries into a lane's top bit if
    there are enough.
    """
    carry = f"({1 << (WIDTH - 1)}L - (n div 2 + 1)) * {ONES}L"
    return " | ".join(
        f"shiftleft(shiftrightunsigned(s{j} + {carry}, {WIDTH - 1}) & {ONES}L, {j})" for j in range(WIDTH)
    )


def _long_majority(stretches: DataFrame, key: list[str]) -> DataFrame:
    """SimHashes of lines with more weight than a lane counts, from the sums of their stretches."""
    counts = [
        F.expr(f"sum(shiftrightunsigned(s{b % WIDTH}, {b // WIDTH * WIDTH}) & {WEIGHTS}L)").alias(f"b{b}") for b in range(BITS)
    ]
    whole = stretches.groupBy(*key).agg(
        F.sum("n").alias("n"), *counts,
        F.max("head").alias("head"), F.max("tail").alias("tail"), F.sum("chars").alias("chars"),
    )
    bits = " | ".join(f"if(b{b} * 2 > n, {1 << b}L, 0L)" for b in range(BITS))
    return whole.selectExpr(*key, f"{bits} AS sim", "head", "tail", "chars - 1 AS chars")


def _keyed(documents: DataFrame) -> DataFrame:
    """The rows as one column, with a key of the id and a hash of the text."""
    return documents.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k0"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("k1"),
    )


def _occurrences(documents: DataFrame) -> DataFrame:
    """``k0, k1, line_no, id, sim, head, tail, chars`` of every line that has a letter or digit:
    head and tail are hashes of its first and last words, null for lines of fewer than six
    words, chars its characters when normalised.

    Words are counted where they are read: the shuffle moves one row of sums per line.
    """
    key = ["k0", "k1", "line_no", "id"]
    lines = _keyed(documents).select("k0", "k1", F.posexplode(F.split("row.text", "\n")).alias("line_no", "line"))
    # What is computed beside posexplode is computed for every word, so the line's values come before.
    # The outer form has no filter for empty arrays put below it, which would split each line twice.
    words = lines.selectExpr("k0", "k1", "line_no", f"{NORMAL_WORDS} AS words", "length(line) AS chars")
    # Half the words, down to the next of 3, 4, 6, 8, 12, 16, 24, ..
    words = words.selectExpr("*", "size(words) div 2 AS half", "shiftleft(1L, length(bin(size(words) div 2)) - 1) AS power")
    words = words.selectExpr("*", "cast(if(half >= power + power div 2, power + power div 2, power) AS int) AS part")
    words = words.selectExpr(
        "k0", "k1", "line_no", "xxhash64(words) AS id", "words", f"({WEIGHT_PLUS} * size(words) + chars) div {WEIGHT_CHARS} > {WEIGHTS} AS long",
        "if(half < 3, NULL, xxhash64(0, slice(words, 1, part))) AS head",
        "if(half < 3, NULL, xxhash64(1, slice(words, -part, part))) AS tail",
    )
    words = words.selectExpr(*key, "long", "head", "tail", "posexplode_outer(words) AS (place, word)").where("word IS NOT NULL")
    weight = f"(length(word) + {WEIGHT_PLUS}) div {WEIGHT_CHARS}"
    weight = f"if(length(word) <= {SHORT_WORD}, 1, if(long, least({weight}, {MOST_WEIGHT}), {weight}))"
    hashes = words.selectExpr(
        *key, "long", "head", "tail", f"if(long, place div {WORDS}, 0) AS stretch", "xxhash64(word) AS h", f"{weight} AS weight",
        "length(word) + 1 AS size",
    )
    # "long" is no key, so that it is tested above the shuffle, which both branches share.
    sums = hashes.groupBy(*key, "stretch").agg(
        F.bool_or("long").alias("long"), F.sum("weight").alias("n"), *_votes("h", "weight"),
        F.max("head").alias("head"), F.max("tail").alias("tail"), F.sum("size").alias("chars"),
    )
    short = sums.where("NOT long").selectExpr(*key, f"{_majority()} AS sim", "head", "tail", "chars - 1 AS chars")
    return short.unionByName(_long_majority(sums.where("long"), key))


def _buckets(kinds: DataFrame) -> DataFrame:
    """``bucket, node, mark`` for every two blocks of a kind's SimHash, and for its head and
    tail. A mark is the SimHash, with the sign bit set in the buckets of heads and tails, and the length.

    Buckets of heads and tails are the negative ones, so that they come before those of
    blocks, in which fewer bits may differ."""
    part = [f"(shiftrightunsigned(sim, {at}) & {(1 << width) - 1}L)" for at, width in BLOCKS]
    keys = [
        f"({t}L * 65536 + {part[a]}) * 65536 + {part[b]}" for t, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    own = f"struct(if(place < {len(keys)}, sim, sim | shiftleft(1L, 63)) AS sim, cast(chars AS int) AS chars) AS mark"
    ends = [f"{end} | shiftleft(1L, 63)" for end in ("head", "tail")]
    rows = kinds.selectExpr("id AS node", "sim", "chars", f"posexplode(array({', '.join([*keys, *ends])})) AS (place, bucket)")
    return rows.where("bucket IS NOT NULL").selectExpr("bucket", "node", own)


def _far(block_bits: int, end_bits: int) -> str:
    """SQL on two marks: the bits or the lengths allow no link."""
    bits = f"bit_count(x.sim ^ y.sim) > if(x.sim < 0, {end_bits}, {block_bits})"
    return f"({bits} OR abs(x.chars - y.chars) > greatest(x.chars, y.chars) div {EDITED})"


def _line_texts(documents: DataFrame, kinds: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, normal`` for the given kinds, from the document of their first occurrence."""
    wanted = nodes.join(kinds, F.expr("node = id")).groupBy("first.k0", "first.k1").agg(
        F.collect_list(F.struct("node", "first.line_no")).alias("own")
    ).withColumnsRenamed({"k0": "w0", "k1": "w1"})
    rows = _keyed(documents).select("k0", "k1", F.col("row.text").alias("text"))
    wanted = small(stored(wanted, "lines-wanted"), ROW_BYTES)
    found = rows.join(wanted, F.expr("k0 = w0 AND k1 = w1")).selectExpr("own", r"split(text, '\n') AS lines")
    # Outer again: the filter would split the text once for each of its lines.
    lines = found.selectExpr("inline_outer(transform(own, o -> struct(o.node AS node, lines[o.line_no] AS line)))")
    # Rows that repeat a document give its lines again.
    return lines.selectExpr("node", f"array_join({NORMAL_WORDS}, ' ') AS normal").dropDuplicates(["node"])


# Whether the next or the last ``k`` characters agree, where ``p`` do already.
_BEGIN = "substring(ta, p + 1, k) = substring(tb, p + 1, k)"
_END = "substring(ta, la - p - k + 1, k) = substring(tb, lb - p - k + 1, k)"


def _once(*columns: str) -> str:
    """SQL that computes columns once: a test of what a generator gives is not put below it, as it
    would be below a projection, with the columns' expressions in each of its places."""
    return f"inline_outer(array(struct({', '.join(columns)})))"


def _common(agree: str) -> str:
    """SQL for a number of characters that both texts begin or end with, at most 15 below the largest one."""
    steps = ", ".join(str(1 << k) for k in range(19, 3, -1))
    return f"aggregate(array({steps}), 0, (p, k) -> if(p + k <= least(la, lb) AND {agree}, p + k, p))"


def edits_within(one: str, two: str, most: int) -> bool:
    """Whether at most so many characters are edited, by Myers' bit vectors: one number holds a
    whole column of the comparison, so a step over a character of ``two`` covers all of ``one``."""
    import numpy as np

    if not one or not two:
        return max(len(one), len(two)) <= most
    codes = np.frombuffer(one.encode("utf-32-le"), dtype="<u4")
    places = {
        chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes).tolist()
    }
    n, edits, left = len(one), len(one), len(two)
    full = (1 << n) - 1
    up, down = full, 0
    for c in two:
        equal = places.get(c, 0)
        zero = (((equal & up) + up) ^ up) | equal | down
        more = (down | (full ^ ((zero | up) & full))) & full
        less = up & zero
        edits += (more >> (n - 1)) - (less >> (n - 1))
        left -= 1
        # Every character that is left takes off one edit at most.
        if edits - left > most:
            return False
        more = (more << 1) | 1
        up = (((less << 1) | (full ^ ((zero | more) & full)))) & full
        down = more & zero & full
    return edits <= most


def _long_links(pairs: DataFrame) -> DataFrame:
    """``a, b`` of those pairs of long texts ``a, b, ta, tb, most`` that are near copies."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            one, two, most = (batch.column(k) for k in (2, 3, 4))
            near = pa.array([edits_within(one[k].as_py(), two[k].as_py(), most[k].as_py()) for k in range(batch.num_rows)], pa.bool_())
            yield batch.select([0, 1]).filter(near)

    return spread(pairs).mapInArrow(run, "a long, b long")


def _near(one: str, two: str, most: str) -> str:
    """SQL: at most so many characters are edited; small numbers, which are cheaper, are tried first."""
    tries = [f"abs(length({one}) - length({two})) + {FEW_EDITS}", str(MORE_EDITS), most]
    tests = [f"levenshtein({one}, {two}, cast(least({tries[0]}, {most}) AS int)) >= 0"]
    for below, top in zip(tries, tries[1:]):
        tests.append(f"{below} < {most} AND {below} < {top} AND levenshtein({one}, {two}, cast(least({top}, {most}) AS int)) >= 0")
    return f"({' OR '.join(tests)})"


def _linker(documents: DataFrame, kinds: DataFrame):
    def linker(nodes: DataFrame):
        texts = stored(_line_texts(documents, kinds, nodes), "lines-texts")
        one = texts.withColumnsRenamed({"node": "na", "normal": "ta"})
        two = texts.withColumnsRenamed({"node": "nb", "normal": "tb"})
        any_long = (texts.agg(F.max(F.length("normal"))).first()[0] or 0) // EDITED > SPARK_EDITS

        def link(pairs: DataFrame) -> DataFrame:
            both = pairs.join(one, F.col("a") == F.col("na")).join(two, F.col("b") == F.col("nb"))
            both = both.selectExpr("a", "b", "ta", "tb", _once("length(ta) AS la", "length(tb) AS lb"))
            both = both.selectExpr("*", f"greatest(la, lb) div {EDITED} AS most").where("abs(la - lb) <= most")
            # What both begin and end with is no edit, and is the most of near copies.
            both = both.selectExpr("*", _once(f"{_common(_BEGIN)} AS p"))
            both = both.selectExpr("a", "b", "most", _once(
                "substring(ta, p + 1) AS ta", "substring(tb, p + 1) AS tb", "la - p AS la", "lb - p AS lb"))
            both = both.selectExpr("*", _once(f"{_common(_END)} AS p"))
            both = both.selectExpr("a", "b", "most", _once("substring(ta, 1, la - p) AS ta", "substring(tb, 1, lb - p) AS tb"))
            test = _near("ta", "tb", f"least(most, {SPARK_EDITS})")
            if not any_long:
                return both.where(test).select("a", "b")
            judged = both.selectExpr("*", _once(f"{test} AS near")).where(f"near OR most > {SPARK_EDITS}")
            judged = stored(judged.selectExpr("a", "b", "if(near, NULL, ta) AS ta", "if(near, NULL, tb) AS tb", "most", "near"), "lines-judged")
            far = judged.where("NOT near").selectExpr("a", "b", "ta", "tb", "cast(most AS long) AS most")
            return judged.where("near").select("a", "b").unionByName(_long_links(far))

        return link

    return linker


def line_groups(documents: DataFrame, block_bits: int = BLOCK_BITS, end_bits: int = END_BITS) -> tuple[DataFrame, DataFrame]:
    """All occurrences of lines, and the kinds that occur more than once with the
    occurrence to keep: ``id, sim, keep``.

    Links are pairs that share a bucket, differ in at most ``block_bits`` or, by their first
    or last words, in at most ``end_bits`` bits, and pass the edit check.
    """
    occurrences = stored(_occurrences(documents), "lines-all")
    # Occurrences of a kind are equal lines, so their heads and tails are equal.
    kinds = stored(occurrences.groupBy("id", "sim").agg(
        F.min(F.struct("k0", "k1", "line_no")).alias("first"), F.count("*").alias("times"),
        F.max("head").alias("head"), F.max("tail").alias("tail"), F.max("chars").alias("chars"),
    ), "lines-kinds")
    groups = near_components(_buckets(kinds), _linker(documents, kinds), _far(block_bits, end_bits), "lines", MANY_PAIRS)
    groups = small(stored(groups, "lines-groups"), 16)
    known = kinds.join(groups, F.col("id") == F.col("node"), "left").where("root IS NOT NULL OR times > 1").select(
        "id", "sim", "first", F.coalesce("root", "id").alias("root")
    )
    keep = known.groupBy(F.col("root").alias("of"), F.expr("pmod(xxhash64(root), 7)").alias("part")).agg(
        F.min("first").alias("keep")
    )
    return occurrences, stored(known.join(keep, F.col("root") == F.col("of")).select("id", "sim", "keep"), "lines-keep")


def _kept(lines: Column, gone: Column) -> Column:
    """The lines whose places are not in the sorted array ``gone``: the stretches between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g + 1))
    stops = F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(lines, a + 1, b - a)))


def dedup_lines(documents: DataFrame, block_bits: int = BLOCK_BITS, end_bits: int = END_BITS) -> DataFrame:
    """The documents without the lines that repeat an earlier one, exactly or nearly.

    All columns stay; ``text`` holds the lines that are left, joined as before, and a
    struct ``lines`` is not added: use ``line_report`` for counts. Lines end at ``\\n``.
    Lines without letters or digits are never removed. A null text stays null, an empty
    one empty; a text may become empty. Rows that repeat a document, id and text, have
    equal results and are no copies of each other; a null doc_id is before any other.
    """
    rows = _without_copies(documents, block_bits, end_bits)
    return rows.select(F.col("row").withField("text", F.array_join("kept", "\n")).alias("row")).select("row.*")


def line_report(documents: DataFrame, block_bits: int = BLOCK_BITS, end_bits: int = END_BITS) -> DataFrame:
    """Per document ``doc_id, n_lines, n_removed, removed, text``: the places of the removed
    lines, and what is left."""
    rows = _without_copies(documents, block_bits, end_bits)
    return rows.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"), F.col("gone").alias("removed"), F.array_join("kept", "\n").alias("text"),
    )


def _without_copies(documents: DataFrame, block_bits: int, end_bits: int) -> DataFrame:
    occurrences, keep = line_groups(documents, block_bits, end_bits)
    copied = small(keep.withColumnsRenamed({"id": "i", "sim": "s"}), ROW_BYTES)
    gone = (
        occurrences.join(copied, F.expr("id = i AND sim = s"))
        .where("struct(k0, k1, line_no) <> keep")
        .groupBy(F.col("k0").alias("g0"), F.col("k1").alias("g1"))
        .agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    )
    gone = small(stored(gone, "lines-gone"), ROW_BYTES)
    joined = _keyed(documents).join(gone, F.expr("k0 = g0 AND k1 = g1"), "left").select(
        "row", F.split("row.text", "\n").alias("lines"), F.coalesce("gone", F.expr("cast(array() AS array<int>)")).alias("gone")
    )
    kept = F.when(F.size("gone") > 0, _kept(F.col("lines"), F.col("gone"))).otherwise(F.col("lines"))
    return joined.select("row", "lines", "gone", kept.alias("kept"))
