"""The n-gram join against all pairs, and its filters."""

import random
import re

import numpy as np
import pytest
import xxhash

from skylag.llm import ngram_join

SCHEMA = "doc_id long, text string, node string, n int, prefix string, bucket int, root string, component_id int"


def brute(rows, percent=90):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        each = [tuple(words[k:k + 3]) for k in range(len(words) - 2)] or ([tuple(words)] if words else [])
        sets.append(frozenset(each))
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def some_rows(seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base = [[rng.choice(words) for _ in range(n)] for n in (200, 200, 40, 12)]
    texts = [None, "", " \t\n", "a b", "A  b", "a", "one two three", "One two\nthree", "a b a b a b a b"]
    for _ in range(160):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(text) // 25))):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append(" ".join(text + [rng.choice(words)] * rng.randint(0, 2)))
    return [(k * 7 % 1000, t) for k, t in enumerate(texts)] + [(None, "one two three"), (None, "nobody else here"), (3, texts[-1]), (3, texts[-1])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z", 3) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("percent", [90, 80])
def test_groups(spark, percent):
    rows = some_rows()
    got = sorted((tuple(r) for r in ngram_join.ngram_groups(frame(spark, rows), percent=percent).collect()), key=str)
    assert got == brute(rows, percent)


def test_template(spark):
    """Many documents that share most words but are no links: each has 15 % words of its own."""
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(k, shared + "".join(f" u{k}x{j}" for j in range(12))) for k in range(400)] + [(400, shared + " end"), (401, shared)]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_groups(frame(spark, rows)).collect()}
    assert got == {k: k for k in range(401)} | {401: 400}


def test_empty_and_long(spark):
    assert ngram_join.ngram_groups(frame(spark, [(1, "x")]).where("false")).count() == 0
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 50_000)}" for _ in range(200_000)]
    other = list(words)
    other[100:5000] = ["new"] * 4900
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[: 150_000]))]
    assert [r.component_id for r in sorted(ngram_join.ngram_groups(frame(spark, rows)).collect())] == [1, 1, 3]


def test_suffix_filter_bounds_the_intersection(spark):
    """The sum over parts is at least the intersection, also where the sets are cut differently, and
    tells unrelated sets apart."""
    import numpy as np

    rng = np.random.default_rng(5)
    rows, want = [], []
    for n, m, both in [(7, 9, 5), (15, 17, 15), (120, 140, 100), (1000, 1100, 900), (1023, 1025, 0), (5000, 5000, 0), (3, 5000, 3)]:
        pool = np.unique(rng.integers(0, 2**64, n + m, dtype=np.uint64))[: n + m - both]
        rng.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(pool[n - both:])
        rows.append((ngram_join.part_counts(a).tolist(), ngram_join.part_counts(b).tolist()))
        want.append((len(a), len(np.intersect1d(a, b))))
    frame = spark.createDataFrame(rows, "a_parts array<int>, b_parts array<int>").coalesce(1)
    got = [r[0] for r in frame.selectExpr(ngram_join._most_common()).collect()]
    assert all(both <= most <= n for most, (n, both) in zip(got, want))
    assert got[4] < 0.9 * 1023 and got[5] < 0.9 * 5000


def test_order_is_rare_first(spark):
    """The prefix holds the shingles that occur in the fewest documents."""
    rows = [(k, "a b c d e f g h i j " + f"rare{k} word{k} here{k}") for k in range(20)]
    docs = frame(spark, rows)
    counts = ngram_join.frequencies(docs)
    assert counts.sum() == 20 * 11
    for r in ngram_join.sets(docs, counts).collect():
        own = ngram_join.shingles(rows[r.doc_id][1]).view("int64").tolist()
        common = set(ngram_join.shingles("a b c d e f g h i j").view("int64").tolist())
        assert r.n == 11 and len(r.prefix) == 2 and not common & set(r.prefix) and set(r.prefix) < set(own)


def test_pairs_left_pass_the_suffix_filter(spark, monkeypatch):
    """Variants of one text that share their rarest common shingle and are no links do not become rows."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):
        text = list(base)
        for at in (1, rng.randrange(30, 58)):
            text[at] = f"v{k}at{at}"
        texts += [" ".join(text), " ".join([*text, f"x{k}"])]
    rows, seen, plain = list(enumerate(texts)), [], ngram_join._linker

    def recorded(*args):
        def linker(nodes):
            link = plain(*args)(nodes)
            return lambda pairs: (seen.append(pairs.collect()), link(pairs))[1]

        return linker

    monkeypatch.setattr(ngram_join, "_linker", recorded)
    got = sorted((tuple(r) for r in ngram_join.ngram_groups(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    sets = {}
    for text in texts:
        own = ngram_join.shingles(text)
        sets[xxhash.xxh64_intdigest(own.tobytes())] = len(own), ngram_join.part_counts(own)
    for r in seen[-1]:
        (n, one), (m, two) = (sets[x & (2 ** 64 - 1)] for x in r)
        assert len(one) == len(two) and 190 * int(np.minimum(one, two).sum()) >= 90 * (n + m)


def test_sets_with_crowded_parts_are_not_filtered(spark):
    """A part's count goes through shuffles as one byte; without parts no pair is told apart."""
    rows = [(k, " ".join(f"w{j}" for j in range(50))) for k in range(2)]
    docs = frame(spark, rows)
    made = ngram_join.sets(docs, ngram_join.frequencies(docs))
    assert dict(made.dtypes)["parts"] == "array<tinyint>"
    pairs = spark.createDataFrame(
        [(9, [5, 4], 9, [4, 5]), (9, [9, 0], 9, [0, 9]), (9, None, 9, [0, 9]), (9, [9, 0], 9, None)],
        "a_n long, a_parts array<byte>, b_n long, b_parts array<byte>",
    )
    assert [r[0] for r in pairs.coalesce(1).selectExpr(ngram_join._unlike(90)).collect()] == [True, True, False, False]


def test_parts_tell_half_equal_sets_apart(spark):
    """Sets with three quarters in common are no links, and few pass the filter."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(40):
        pool = rng.integers(0, 2**64, 500, dtype=np.uint64)
        a, b = np.sort(pool[:400]), np.sort(pool[100:])
        rows.append((400, ngram_join.part_counts(a).tolist(), 400, ngram_join.part_counts(b).tolist()))
    pairs = spark.createDataFrame(rows, "a_n long, a_parts array<int>, b_n long, b_parts array<int>").coalesce(1)
    assert sum(r[0] for r in pairs.selectExpr(ngram_join._unlike(90)).collect()) >= 30
