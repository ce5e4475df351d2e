"""The operators against brute force on small tables with nulls, empty texts, repeats and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex
import sentencepiece
import xxhash
from conftest import SF_SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry
from skylag.llm import (
    ann, bloom_lm, decontam, line_dedup, pieces, queries, simhash, suffix_dedup, token_files, toxicity, warc,
)
from skylag.llm.common import near_components
from skylag.llm.oracle import oracle_sql

WORDS = ["ab", "Cd", "éf", "gh,", "ij.", "KL", "mn", "op", "q", "rs", "tu", "vw"]
CLASHING = "doc_id long, text string, lang string, k0 long, node string, row_id long, hits string, rank int, n_chars long"


def some_texts(n=40, seed=5):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(60)) for _ in range(6)]
    texts = [None, "", " \t\n", "one", base[0], base[0]]
    for _ in range(n):
        text = rng.choice(base)
        cut = rng.randint(0, len(text) // 2)
        texts.append(text[cut:] + ("\n" if rng.random() < 0.5 else " ") + rng.choice(base)[: rng.randint(0, 200)])
    return texts


def documents(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", 1, "x", 2, "y", 3, None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    return some_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return documents(spark, texts)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_warc(spark):
    big, other = "ü" * 600, "z" * 2000
    rows = [(1, "u1", big, 0), (2, None, big, 0), (3, "u\r\n3", None, 0), (4, "u4", "", 0), (5, "u5", "small", 0),
            (6, "u6", "small", 0), (7, "u7", other, 0), (2, "u2", big, 0), (None, "u8", other, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest int").repartition(2)
    got = Counter(tuple(r) for r in warc.archive_pages(pages, roll_bytes=700).collect())
    want = Counter()
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        keep = {big: 2, other: 7}.get(html)
        kind = "response" if keep in (None, page_id) else "revisit"
        want[page_id, len(data), hashlib.sha1(data).hexdigest(), kind, keep if kind == "revisit" else None] += 1
    assert got == want
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_toxicity(spark):
    rng = random.Random(1)
    plain = ["river", "stone", "cloud", "apple", "green", "house", "paper", "light"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        sentences = [" ".join(rng.choice(plain) for _ in range(6)) for _ in range(5)]
        if bad:
            sentences[2] += " " + rng.choice(["foulwort", "foulmuck"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    labels += [(1, None), (None, 1), (2, 0)]
    docs = documents(spark, [t for _, t in rows] + [None, "", "foulwort."], [*range(400), 400, 401, None])
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(docs, frame))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) >= 0.99 * len(held)
    assert got[400].score == got[401].score == 0.0 and got[None].predicted == 1
    place = got[0].sentences[0]
    assert "foul" in rows[0][1][place.start:place.start + place.length] and len(got[0].sentences) == 1
    kept = toxicity.drop_toxic(docs, frame)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    assert toxicity.toxicity(docs.where("false"), frame.where("false")).count() == 0


def test_long_texts_are_learned_and_clean_ones_kept(spark):
    rng = random.Random(2)
    plain = ["river", "stone", "cloud", "apple", "green", "house", "paper", "light"]

    def text(n, bad=None, length=6):
        made = [" ".join(rng.choice(plain) for _ in range(length)) for _ in range(n)]
        if bad:
            made[n // 2] += " " + bad
        return ". ".join(made) + "."

    texts = [text(5, "foulwort" if i % 4 == 0 else None) for i in range(400)]
    labels = [(i, int(i % 4 == 0)) for i in range(400)]
    texts += [text(70, "vilemuck" if i % 2 else None, 60) for i in range(40)]
    labels += [(400 + i, i % 2) for i in range(40)]
    assert min(map(len, texts[400:])) > toxicity.FIT_CHARS
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer = toxicity.Scorer(*toxicity.fit_sample(documents(spark, texts), frame))
    for n in (2000, 5000, 20_000):
        assert scorer.score(text(n))[0] < 0.5
        for bad in ("foulwort", "vilemuck"):
            score, found = scorer.score(text(n, bad))
            assert score >= 0.5 and len(found) == 1


def test_token_files(spark, docs, texts, empty):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    extra = ["It's, well. • done•x <|endoftext|> a", "I'll co-op 日本 naïve  x y", "É. A!? b.. c,"]
    frame = documents(spark, texts + extra + ["null id"], [*range(len(texts) + 3), None])
    got, start = {r.doc_id: r for r in token_files.token_files(frame, queries.TOKENIZER, 2).collect()}, 0
    for i, text in [(None, "null id"), *enumerate(texts + extra)]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert token_files.token_files(empty, queries.TOKENIZER, 2).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def line_sim(normal):
    words = normal.split(" ")
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    most = 8 if (5 * len(words) + len(normal)) // 3 > 511 else 511
    weights = [1 if len(w) <= 3 else min(most, (len(w) + 5) // 3) for w in words]
    return sum(1 << b for b in range(63) if 2 * sum(w for h, w in zip(hashes, weights) if h >> b & 1) > sum(weights))


def line_ends(normal):
    """The words that a line's two other buckets stand for."""
    words = normal.split(" ")
    half = len(words) // 2
    if half < 3:
        return None
    part = max(n for k in range(20) for n in (2 ** k, 3 * 2 ** k // 2) if n <= half)
    return words[:part], words[-part:]


def line_link(x, y):
    """Whether two normalised lines meet in a bucket and are near copies."""
    blocks = [(0, 16), (16, 16), (32, 16), (48, 15)]
    turned = line_sim(x) ^ line_sim(y)
    ends = line_ends(x), line_ends(y)
    meet = turned.bit_count() <= 8 and sum(not turned >> at & (1 << width) - 1 for at, width in blocks) >= 2
    meet = meet or turned.bit_count() <= 18 and None not in ends and (ends[0][0] == ends[1][0] or ends[0][1] == ends[1][1])
    most = min(max(len(x), len(y)) // 5, 1024)
    return meet and abs(len(x) - len(y)) <= most and distance(x, y) <= most


def find(parent, a):
    while parent[a] != a:
        a = parent[a]
    return a


def test_line_dedup(spark, empty):
    rng = random.Random(3)
    long_ = " ".join(f"word{rng.randint(0, 400)}" for _ in range(600))
    near = long_.split(" ")
    near[30] = "other"
    texts = [None, "", "\n\n", "Same line here.\nalone", "same LINE, here!\nSame line here", long_, " ".join(near),
             "tail " + long_ + "\nsame line here", "...\n...", "x\ny\nx"]
    frame = documents(spark, texts)
    kinds, occurrences = {}, []
    for i, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            normal = " ".join(w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w)
            if normal:
                occurrences.append((i, k, kinds.setdefault(normal, len(kinds))))
    names, parent = list(kinds), list(range(len(kinds)))
    for a in range(len(names)):
        for b in range(a):
            if line_link(names[a], names[b]):
                parent[find(parent, a)] = find(parent, b)
    first, gone = {}, defaultdict(list)
    for i, k, kind in occurrences:
        if first.setdefault(find(parent, kind), (i, k)) != (i, k):
            gone[i].append(k)
    got = by_id(line_dedup.line_report(frame))
    assert {i: r.removed for i, r in got.items()} == {i: gone[i] for i in range(len(texts))}
    assert got[6].n_removed == 1 and got[0].text is None and got[9].text == "x\ny"
    kept = line_dedup.dedup_lines(frame)
    assert kept.columns == frame.columns and kept.count() == len(texts)
    assert line_dedup.dedup_lines(empty).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_finds_other_words(spark, tmp_path):
    """One word of 10 to 40 replaced, and words put in front of lines of many zones."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    lines, near = [], []
    for n, front in [(10, 0), (20, 0), (40, 0), (120, 1), (120, 5), (300, 5)]:
        for _ in range(30):
            line = [rng.choice(words) for _ in range(n)]
            other = ["front"] * front + line
            if not front:
                other[rng.randrange(n)] = "othery"
            lines.append(" ".join(line))
            near.append(" ".join(other))
    alone = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(200)]
    documents(spark, lines + alone + near).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(queries.op4_line_dedup(spark, str(tmp_path)))
    first = len(lines) + len(alone)
    assert all(got[i].n_removed == 0 for i in range(first))
    found = [got[first + i].n_removed for i in range(len(near))]
    for at in range(0, len(near), 30):
        assert sum(found[at:at + 30]) >= 28


def test_registered_line_dedup(spark, tmp_path):
    """The query, on lines with words changed, put in, left out and made longer, against all pairs."""
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    lines = []
    for n in (3, 5, 6, 8, 12, 20, 33, 60, 130):
        for _ in range(4):
            line = [rng.choice(words) for _ in range(n)]
            lines.append(line)
            for _ in range(4):
                other = list(line)
                for _ in range(rng.randint(1, 2)):
                    at = rng.randrange(len(other))
                    kind = rng.randrange(4)
                    if kind == 0:
                        other[at] = rng.choice(words)
                    elif kind == 1:
                        other.insert(at, rng.choice(words))
                    elif kind == 2 and len(other) > 1:
                        del other[at]
                    else:
                        other[at] += "".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 20, 60])))
                lines.append(other)
    normal = [" ".join(x) for x in lines]
    order = rng.sample(range(len(normal)), len(normal))
    texts = ["\n".join(normal[k] for k in order[at:at + 7]) for at in range(0, len(order), 7)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(queries.op4_line_dedup(spark, str(tmp_path)))
    kinds = sorted(set(normal))
    parent = list(range(len(kinds)))
    for a in range(len(kinds)):
        for b in range(a):
            if abs(len(kinds[a]) - len(kinds[b])) <= 60 and find(parent, a) != find(parent, b) and line_link(kinds[a], kinds[b]):
                parent[find(parent, a)] = find(parent, b)
    seen, gone = set(), 0
    for i, text in enumerate(texts):
        removed = []
        for k, line in enumerate(text.split("\n")):
            group = find(parent, kinds.index(line))
            if group in seen:
                removed.append(k)
            seen.add(group)
        gone += len(removed)
        assert got[i].removed == removed
    assert gone > 60


@pytest.mark.parametrize("free", ["word", "hash"])
def test_lines_on_one_template(spark, free):
    """Very many lines that differ in one free word: a short one makes all of them near copies, a
    long one none. Neither ends in all pairs."""
    rng = random.Random(6)
    start, end = "the report of today was written by user", "and sent to all readers"
    made = ["".join(rng.choice("0123456789abcdef") for _ in range(6 if free == "word" else 60)) for _ in range(20_000)]
    rows = [(i, "\n".join(f"{start} {m} {end}" for m in made[i * 200:(i + 1) * 200])) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    removed = line_dedup.line_report(frame).agg({"n_removed": "sum"}).first()[0]
    assert removed == (19_999 if free == "word" else 0)


def test_very_long_lines(spark):
    """Lines of a million characters are compared in a bounded number of edits."""
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 9999)}" for _ in range(170_000)]
    other = [*words[:100], "new", *words[101:]]
    far = [*words[:90_000], *[f"v{k}" for k in range(80_000)]]
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((words, other, far))], "doc_id long, text string")
    got = by_id(line_dedup.line_report(frame))
    assert [got[k].n_removed for k in range(3)] == [0, 1, 0]


def test_long_lines_with_many_edits(spark):
    """One character of five may be edited in lines of any length."""
    rng = random.Random(15)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(2200)]
    put_in = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    other = [*words[:1500], *put_in, *words[1500:]]
    frame = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(other))], "doc_id long, text string")
    got = by_id(line_dedup.line_report(frame))
    assert [got[k].n_removed for k in range(2)] == [0, 1]


def test_edits_within():
    """The comparison of long texts against the plain one, for every bound."""
    rng = random.Random(1)
    for _ in range(300):
        one, two = ("".join(rng.choice("abé😀") for _ in range(rng.randint(0, 14))) for _ in range(2))
        row = list(range(len(two) + 1))
        for k, x in enumerate(one, 1):
            new = [k]
            for j, y in enumerate(two, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        assert [line_dedup.edits_within(one, two, most) for most in range(16)] == [row[-1] <= most for most in range(16)]


def test_pairs_that_are_far_by_blocks_only(spark):
    """Lines that share blocks and first words, with more bits apart than blocks allow, are still compared."""
    other = sum(1 << b for b in range(32, 42))
    kinds = [(1, 0), (10, 0), (11, other), (20, 0)]
    frame = spark.createDataFrame(
        [(node, sim, 100, 1 << 62, None) for node, sim in kinds], "id long, sim long, chars long, head long, tail long"
    )
    groups = near_components(
        line_dedup._buckets(frame), lambda nodes: lambda pairs: pairs.where("a = 10 AND b = 11"), line_dedup._far(8, 18), "test"
    )
    assert sorted(tuple(r) for r in groups.collect()) == [(10, 10), (11, 10)]


def test_bloom_lm(spark, docs, texts, empty):
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = Counter(w for i in words if not held[i] for w in words[i])
    total = counts.total()
    whole = by_id(bloom_lm.lm_scores(docs))
    parted = by_id(bloom_lm.lm_scores(docs, hot=5, filter_bytes=total, slice_grams=64))
    for i, own in words.items():
        base = sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        known = sum(w in counts for w in own)
        for got in (whole[i], parted[i]):
            assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (held[i], len(own), known, total)
            assert got.base_score == pytest.approx(base, rel=1e-12)
    assert sum(r.score for r in whole.values()) > sum(r.base_score for r in whole.values())
    assert bloom_lm.lm_scores(empty).count() == 0


def test_bloom_scores(spark, docs, texts):
    """Scores from exact counts: the filter rarely errs, and never by much."""
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"] for i, t in enumerate(texts)}
    ones, pairs = Counter(), Counter()
    for i, own in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ones.update(own)
            pairs.update(zip(["\n", *own], own))
    smooth = ones.total() + len(ones) + 1

    def middle(c):
        return (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0

    got, gaps = by_id(bloom_lm.lm_scores(docs)), []
    for i, own in words.items():
        want = 0.0
        for first, second in zip(["\n", *own], own):
            context = max(middle(ones[first]), middle(pairs[first, second]))
            share = bloom_lm.PAIR_SHARE if context else 0.0
            want += np.log10(share * middle(pairs[first, second]) / max(context, 1) + (1 - share) * (middle(ones[second]) + 1) / smooth)
        gaps.append(abs(got[i].score / want - 1))
    assert np.mean(gaps) < 0.03 and max(gaps) < 0.3


def test_counts_are_read_back():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    start, step = bloom_lm.strides(h)
    assert (bloom_lm.expected(np.array([0, 1, 2, 3])) == [0, 1, 2.5, 5.5]).all()
    size = len(h) * bloom_lm.BITS
    bits = np.zeros(size, dtype=bool)
    for place in bloom_lm.places_of(start, step, 1, np.uint64(size)):
        bits[place.view(np.int64)] = True
    held = bloom_lm.Filter(np.packbits(bits, bitorder="little"), {(2, 0): (0, size)}, {2: 1})
    assert (held.level(2, h) >= 1).all()
    assert (held.level(2, h + np.uint64(1)) >= 1).mean() < 0.05


def test_nearest(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 8)).astype(np.float32)
    vectors[100:260] = 4 * vectors[100]
    rows = [(i, [float(x) for x in v], 0.0) for i, v in enumerate(vectors)]
    rows += [(600, None, 0.0), (620, [0.0] * 8, 0.0), (640, [None] + [1.0] * 7, 0.0), (660, [float("nan")] * 8, 0.0), (0, rows[0][1], 0.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = defaultdict(list)
    for r in ann.nearest(frame, list_vectors=50).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    wide, hits = vectors.astype(np.float64), 0
    for q, found in got.items():
        scores = wide @ wide[q]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:20]
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(order))
    assert hits >= 0.95 * 20 * len(got)
    assert [v for _, v, _ in got[120]] == [*range(100, 120)]
    assert ann.nearest(frame.where("false")).count() == 0
    assert ann.nearest(frame.where("vec_id IN (0, 1, 2)")).count() == 2


def unit_vectors(rng, n, dims=64):
    vectors = rng.normal(size=(n, dims))
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


def test_all_lists_within_the_ratio_are_found():
    rng = np.random.default_rng(6)
    lists = ann.Lists(unit_vectors(rng, 4000), 200)
    assert min(map(len, lists.edges)) >= ann.DEGREE
    points, ratio = unit_vectors(rng, 300), 1.12
    all_ = np.sqrt(((points[:, None] - lists.centers[None]) ** 2).sum(axis=2))
    want = all_ <= ratio * all_.min(axis=1, keepdims=True)
    assert want.sum(axis=1).max() > ann.BEAM
    got = np.zeros_like(want)
    for q, point in enumerate(points):
        for d, c in lists.search(point, ratio):
            assert abs(d - all_[q, c]) < 1e-9
            got[q, c] = True
    assert (got & want).sum() >= 0.999 * want.sum()


def test_homes_are_few_and_apart():
    """A vector is in its closest list; in others only if none it is in lies nearer to them than it does."""
    rng = np.random.default_rng(3)
    vectors = unit_vectors(rng, 2000, 8)
    lists = ann.Lists(vectors, 50)
    sizes = np.zeros(50, dtype=int)
    for v in vectors:
        homes = lists.homes(v)
        d = np.sqrt(((lists.centers - v) ** 2).sum(axis=1))
        assert 1 <= len(homes) <= ann.COPIES and homes[0] == d.argmin() and d[homes].max() <= ann.BOUNDARY * d.min()
        for k, c in enumerate(homes):
            assert all(((lists.centers[c] - lists.centers[o]) ** 2).sum() > d[c] ** 2 for o in homes[:k])
        sizes[homes] += 1
    assert sizes.sum() > 2000 and sizes.max() < 4 * sizes.mean()


@pytest.mark.parametrize("flat", [True, False])
def test_recall_where_lists_are_pruned(spark, flat, monkeypatch):
    """Isotropic vectors, as in the given table, and vectors in clusters; also with many small units."""
    rng = np.random.default_rng(8)
    vectors = unit_vectors(rng, 8000) if flat else unit_vectors(rng, 8000) / 3 + unit_vectors(rng, 80)[rng.integers(0, 80, 8000)]
    vectors = vectors.astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "UNIT_BYTES", 64 * 8 * 700)
    monkeypatch.setattr(ann, "UNIT_QUERIES", 150)
    got = defaultdict(set)
    for r in ann.nearest(frame, list_vectors=100).collect():
        got[r.query_id].add(r.vec_id)
    wide, hits = vectors.astype(np.float64), 0
    for q, found in got.items():
        scores = wide @ wide[q]
        scores[q] = -np.inf
        hits += len(found & set(np.argsort(-scores)[:20].tolist()))
    assert len(got) == 400 and hits >= 0.9 * 20 * len(got)
    whole = wide[:3000]
    lists = ann.Lists(ann._extended(whole, np.sqrt((whole**2).sum(axis=1)).max(), False), 30)
    ratio = ann.probe_ratio(lists, ann._extended(whole, np.sqrt((whole**2).sum(axis=1)).max(), False), ann._extended(whole[:200], 1, True), 20)
    read = np.mean([len(lists.search(p, ratio)) for p in ann._extended(whole[:200], 1, True)]) / 30
    assert read < (1 if flat else 0.5)


def test_many_lengths_of_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=1 + k % 130).tolist()) for k in range(1300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(frame).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    for q, found in got.items():
        own = [(-float(np.dot(rows[k][1], rows[q][1])), k) for k in range(q % 130, 1300, 130) if k != q]
        assert found == [k for _, k in sorted(own)][:20]
    assert len(got) == 65


def test_simhash(spark, docs, texts, empty):
    prints = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = list(range(len(texts)))
    for a in parent[:]:
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[find(parent, a)] = find(parent, b)
    least = {}
    for i in range(len(texts)):
        least.setdefault(find(parent, i), i)
    got = by_id(simhash.simhash_groups(docs))
    assert {i: (r.fp % (1 << 64), r.component_id) for i, r in got.items()} == {
        i: (prints[i], least[find(parent, i)]) for i in prints}
    kept = simhash.drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values()) and kept.columns == docs.columns
    twice = documents(spark, ["a b c d e"] * 3, [None, 7, 7])
    assert [r.doc_id for r in simhash.drop_near_copies(twice).collect()] == [7]
    assert simhash.simhash_groups(empty).count() == 0


def test_near_copies_without_or_with_shared_ids(spark):
    rng = random.Random(9)
    clean = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) for _ in range(26)]
    ids = [None] * 20 + [7, 7, 7, 8, 9, 9]
    copies = [(None, clean[0]), (5, clean[1]), (6, clean[21]), (7, clean[20])]
    frame = documents(spark, clean + [t for _, t in copies], ids + [i for i, _ in copies])
    kept = simhash.drop_near_copies(frame)
    want = Counter(zip(ids, clean)) - Counter([(None, clean[1]), (7, clean[21])]) + Counter(copies[1:3])
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_anchors_meet():
    rng = np.random.default_rng(4)
    x = rng.integers(-(1 << 62), 1 << 62, 200)
    for bits in range(5):
        y = x.copy()
        for k in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[k] ^= np.array([1 << int(b)], dtype=np.uint64).view(np.int64)[0]
        own, other = defaultdict(set), defaultdict(set)
        for frame, values in ((own, x), (other, y)):
            for anchor, owner in zip(*simhash.anchors_of(values)):
                frame[int(owner)].add(int(anchor))
        assert all(own[k] & other[k] for k in range(len(x)))


@pytest.mark.parametrize("crowd", [2000, 2])
def test_suffix_dedup(spark, docs, texts, empty, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    width = 24
    data = {i: (t or "").encode() for i, t in enumerate(texts)}
    counts = Counter(d[k:k + width] for d in data.values() for k in range(len(d) - width + 1))
    got = by_id(suffix_dedup.remove_repeats(docs, width, 8))
    for i, d in data.items():
        gone = [False] * len(d)
        for k in range(len(d) - width + 1):
            if counts[d[k:k + width]] > 1:
                gone[k:k + width] = [True] * width
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_array_order():
    rng = random.Random(6)
    for _ in range(100):
        s = [rng.randint(1, 4) for _ in range(rng.randint(1, 200))] + [0]
        order = list(suffix_dedup.induced_order(s, 5))
        assert order == sorted(range(len(s)), key=lambda k: s[k:])
        text = bytes(s)
        shared = suffix_dedup.common_prefixes(text, order)
        for before, k in zip(order, order[1:]):
            n = 0
            while max(before, k) + n < len(text) - 1 and text[before + n] == text[k + n]:
                n += 1
            assert shared[k] == n


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_decontaminate(spark, docs, texts, empty, block_bytes):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [(1, texts[4][50:200]), (2, texts[4][100:300]), (3, None), (4, ""), (5, "ab1 cd2"), (6, texts[9][:90]), (10, texts[4][50:200])]
    windows = defaultdict(set)
    for item, text in items:
        words = word.findall(lower(text))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k:k + n])].add(str(item))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontam.contaminated_words(docs, benchmark, block_bytes=block_bytes, shard_words=100).collect()}
    bad = set()
    for i, text in enumerate(texts):
        words, hit, found = word.findall(lower(text)), set(), set()
        for key, own in windows.items():
            for k in range(len(words) - len(key) + 1):
                if tuple(words[k:k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    found |= own
        bad |= {i} if hit else set()
        assert got[i].n_words == len(words) and got[i]["items"] == sorted(found)
        assert sum(h.b - h.a for h in got[i].hits) == len(hit)
    assert bad and {r.doc_id for r in decontam.decontaminate(docs, benchmark).collect()} == set(got) - bad
    assert decontam.contaminated_words(docs, benchmark.where("false")).where("size(hits) > 0").count() == 0
    assert decontam.contaminated_words(empty, benchmark).count() == 0


@pytest.mark.parametrize("shard_words, block_bytes", [(1_000_000, 1 << 20), (60, 1 << 20), (60, 150)])
def test_longest_matches(spark, shard_words, block_bytes):
    """The longest common run of words of every item, over all documents, against all places."""
    rng = random.Random(14)
    words = [f"w{k}" for k in range(40)]
    whole = [[rng.choice(words) for _ in range(rng.randint(0, 60))] for _ in range(40)]
    items = [("a", whole[3][5:30]), ("b", whole[4][:12] + ["zz"] + whole[9][:14]), ("c", whole[7][2:6]), ("d", ["qq"] * 20),
             ("e", whole[5][:20] + whole[5][:20]), ("f", []), (None, whole[11][:15]), ("g", ["r"] * 30)]
    whole += [["r"] * 25, ["r"] * 25, whole[3], ["x", "x"] + whole[3][4:40]]
    ids = [*range(len(whole) - 1), None]
    docs = documents(spark, [" ".join(w).upper() for w in whole], ids)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id string, text string")
    got = {r.item_id: tuple(r)[1:] for r in decontam.longest_matches(docs, benchmark, 10, block_bytes, shard_words).collect()}
    want = {}
    for name, item in items:
        best = None
        for p in range(len(item)):
            for doc_id, words in zip(ids, whole):
                for q in range(len(words)):
                    n = 0
                    while p + n < len(item) and q + n < len(words) and item[p + n] == words[q + n]:
                        n += 1
                    key = (-n, p, doc_id is None, doc_id or 0, q)
                    if n >= min(10, len(item)) and n and (best is None or key < best):
                        best = key
        if best:
            want[str(name)] = (-best[0], best[1], None if best[2] else best[3], best[4])
    assert got == want and len(want) >= 5
    assert decontam.longest_matches(docs.where("false"), benchmark).count() == 0


def test_clashing_columns_stay(spark):
    frame = spark.createDataFrame(
        [(1, "one two three four five", "a", "b", "c", "d"), (2, "one two three four five", "a", "b", "c", "d")],
        "doc_id long, text string, _decontam_id string, _simhash_text string, row string, bad_id string",
    )
    benchmark = spark.createDataFrame([("i", "nothing here")], "item_id string, text string")
    assert decontam.decontaminate(frame, benchmark).collect() == frame.collect()
    assert simhash.drop_near_copies(frame).collect() == frame.where("doc_id = 1").collect()
    assert simhash.drop_near_copies(frame.where("false")).columns == frame.columns
    assert simhash.drop_near_copies(frame.where("false")).count() == 0


def test_unigram_pieces(spark, tmp_path):
    """A unigram model, with extra white space removed, against the library's shortest paths."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(queries.PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    model.normalizer_spec.remove_extra_whitespaces = True
    path = f"{tmp_path}/unigram.model"
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["hello  world ", " two   words, and more", "a", "", "   ", "été 日本 done"]
    docs = documents(spark, texts).withColumn("piece_ids", docs_column())
    from skylag.llm import pieces as p

    fst = p.Transducer(path)
    for text in texts:
        own, other = fst.encode(text), library.encode(text)
        weigh = lambda ids: sum(model.pieces[k].score for k in ids)
        assert own == other or abs(weigh(own) - weigh(other)) < 1e-3 * abs(weigh(other))
    encoded = by_id(p.encode(docs, path))
    assert {i: list(r.piece_ids) for i, r in encoded.items()} == {i: fst.encode(t) for i, t in enumerate(texts)}


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_noisy_or_is_the_sum_of_sentences(spark):
    """The score, recomputed from the model: one minus the product of the sentences' complements,
    each sentence counted beyond a plain one."""
    model = (-4.0, {"^bad$": 5.0, "^ill$": 2.5, "^good$": -3.0})
    texts = ["bad words. good words. ill words!", "good day. plain day.", "bad ill bad. bad good", "", None, "ill. ill. ill. ill"]
    docs = documents(spark, texts)
    got = by_id(toxicity.score_documents(docs, model))
    weights = {"bad": 5.0, "ill": 2.5, "good": -3.0}
    for i, text in enumerate(texts):
        plain = 1 + np.exp(-4.0)
        none, bad = 1.0, 0
        for sentence in re.split("[.!?\n]+", text or ""):
            logit = -4.0 + sum(weights.get(w, 0.0) for w in set(sentence.split()))
            if logit > -4.0:
                none *= plain / (1 + np.exp(logit))
            bad += logit >= 0
        assert abs(got[i].score - (1 - none)) < 1e-12 and len(got[i].sentences) == bad
        assert got[i].predicted == (got[i].score >= 0.5)


def test_sidecar_offsets(spark, tmp_path):
    """Every record can be inflated alone from the place that the sidecar names."""
    pages = spark.createDataFrame([(k, f"u{k}", f"page {k} " * (k * 50)) for k in range(30)], "page_id long, url string, html string")
    uri = f"file://{tmp_path}/warc"
    archives = warc.write_archives(warc.mark_revisits(pages), uri, roll_bytes=2000).collect()
    made = {r.archive for r in warc.normalise(spark.createDataFrame(archives, "archive string"), uri).collect()}
    seen = []
    for name in made:
        data = (tmp_path / "warc" / name).read_bytes()
        end = 0
        for line in (tmp_path / "warc" / f"{name}.idx").read_text().splitlines():
            offset, length, record_id = line.split()
            assert int(offset) == end
            end += int(length)
            record = zlib.decompressobj(31).decompress(data[int(offset):end])
            assert f"WARC-Record-ID: {record_id}".encode() in record and record.endswith(b"\r\n\r\n")
            seen.append(record_id)
        assert end == len(data)
    assert sorted(seen) == sorted(f"<urn:page:{k}>" for k in range(30))


def test_pieces(spark, docs, texts, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    extra = ["Hello  wörld \n\t日本 😀 don't", "    ", "end.. x,"]
    frame = documents(spark, texts + extra)
    got = by_id(pieces.round_trip(frame, queries.PIECES))
    for i, text in enumerate(texts + extra):
        assert list(got[i].piece_ids) == library.encode(text or "") and got[i].same
    encoded = pieces.encode(frame, queries.PIECES)
    back = by_id(pieces.decode(encoded, queries.PIECES))
    assert {i: r.text for i, r in back.items()} == dict(enumerate(texts + extra))
    assert pieces.round_trip(empty, queries.PIECES).count() == 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    result = entry.queries()[name](spark, SF_SMALL)
    columns = ", ".join(sorted(result.columns))
    want = con.execute(f"SELECT {columns} FROM ({oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, result.select(*sorted(result.columns)).collect())) == Counter(want)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty texts, repeated rows, clashing names and empty tables pass every stage."""
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, label int, h long"
    rows = [(1, None), (2, ""), (None, "some words stand here"), (None, None), (3, "other words in a line\nand another line"),
            (3, "other words in a line\nand another line"), (4, "x " * 30_000)]
    frame = spark.createDataFrame([(i, t, None, "s", None, "n", "r", 7, 8) for i, t in rows], schema)
    want = {"toxicity": 7, "line dedup": 7, "simhash near-dedup": 4, "decontamination": 4}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, frame, str(tmp_path))
        assert left.columns == frame.columns and stage(spark, frame.where("false"), str(tmp_path)).count() == 0
        frame = spark.createDataFrame(left.collect(), schema)
        assert frame.count() == want[name]
    ids = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
    assert ids.count() == 4 and corpus_pipeline.STAGES[-1][1](spark, frame.where("false"), str(tmp_path)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    frame, seen = docs, {}
    for name, stage in list(stages.items())[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, SF_SMALL).toPandas(), docs.schema)
        seen[name] = {r.doc_id: r.text for r in frame.collect()}
        assert frame.columns == docs.columns
    counts = [len(s) for s in seen.values()]
    assert docs.count() > counts[0] == counts[1] >= counts[2] > counts[3] > 0
    groups = by_id(simhash.simhash_groups(spark.createDataFrame(list(seen["line dedup"].items()), "doc_id long, text string")))
    assert set(seen["simhash near-dedup"]) == {i for i, r in groups.items() if r.component_id == i}
    left = decontam.contaminated_words(frame, benchmark).where("size(hits) > 0").count()
    assert left == 0
    got = by_id(corpus_pipeline.run(spark, SF_SMALL))
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    assert {i: list(r.piece_ids) for i, r in got.items()} == {
        i: library.encode(t) for i, t in seen["decontamination"].items()}
