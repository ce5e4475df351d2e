"""Documents in blocks, whose n-grams go to the slices of the filter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException

from skylag.llm import bloom_lm
from skylag.llm.bloom_lm import PAIRS, WORDS

SCHEMA = "doc_id long, text string"


def some_rows(n=60, seed=3):
    rng = random.Random(seed)
    words = ["Ab", "éc", "d,", "e.", "日本", "f", "g"]
    texts = [" ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    rows = [(k, t) for k, t in enumerate(texts)]
    # Null ids and texts, no words, rows that repeat, one id with two texts.
    return rows + [(None, texts[0]), (None, None), (100, None), (101, ""), (102, " \n"), (3, texts[3]), (3, texts[3]), (4, texts[9])]


def exact_scores(rows):
    """Counter of id, held out, tokens, known, base score and the score from exact counts."""
    def own(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]

    def middle(c):
        return (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0

    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    ones, pairs = Counter(), Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            ones.update(own(text))
            pairs.update(zip(["\n", *own(text)], own(text)))
    smooth, found = ones.total() + len(ones) + 1, []
    for (i, text), out in zip(rows, held):
        score = 0.0
        for first, second in zip(["\n", *own(text)], own(text)):
            context = max(middle(ones[first]), middle(pairs[first, second]))
            share = bloom_lm.PAIR_SHARE if context else 0.0
            score += np.log10(share * middle(pairs[first, second]) / max(context, 1) + (1 - share) * (middle(ones[second]) + 1) / smooth)
        base = sum(np.log10((ones[w] + 1) / smooth) for w in own(text))
        found.append((i, out, len(own(text)), sum(w in ones for w in own(text)), ones.total(), base, score))
    return found


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))


@pytest.mark.parametrize("gather, small", [(1 << 20, {}), (50, {"slice_grams": 16, "filter_bytes": 64})])
def test_documents_are_read_twice_at_any_size(spark, monkeypatch, gather, small):
    """They were read once more for every ``filter_bytes`` of filter."""
    monkeypatch.setattr(bloom_lm, "GATHER", gather)
    rows = some_rows()
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).mapInArrow(counted, SCHEMA)
    got = ordered(map(tuple, bloom_lm.lm_scores(docs, **small).collect()))
    assert read.value == 2 * len(rows)
    want, gaps = ordered(exact_scores(rows)), []
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-12)
        gaps.append(abs(g[6] / w[6] - 1))
    assert np.median(gaps) < 0.03 and np.mean(gaps) < 0.06 and max(gaps) < 0.5


def test_blocks_and_slices_change_no_score_but_by_the_filter(spark, monkeypatch):
    """One slice of each kind holds the same members however the documents are cut."""
    docs = spark.createDataFrame(some_rows(), SCHEMA).repartition(3)
    whole = ordered(map(tuple, bloom_lm.lm_scores(docs).collect()))
    monkeypatch.setattr(bloom_lm, "GATHER", 1)
    cut = ordered(map(tuple, bloom_lm.lm_scores(docs.coalesce(1)).collect()))
    assert [r[:5] for r in cut] == [r[:5] for r in whole]
    assert np.allclose([r[5:] for r in cut], [r[5:] for r in whole], rtol=1e-12)


def test_a_missing_answer_is_an_error(spark):
    rows = spark.createDataFrame(some_rows(), SCHEMA).selectExpr("doc_id", "cast(text AS binary) AS text", "false AS held_out")
    answered = bloom_lm.answers(bloom_lm.gram_rows(rows.coalesce(1), {PAIRS: 4, WORDS: 4})).localCheckpoint()
    assert bloom_lm.block_scores(answered, 1, 1.0).count() == len(some_rows())
    for kind in (WORDS, PAIRS):
        with pytest.raises(PythonException, match="do not match"):
            bloom_lm.block_scores(answered.where(f"NOT (kind = {kind} AND key = 3)"), 1, 1.0).collect()


def test_hashes_travel_as_steps():
    rng = np.random.default_rng(0)
    h = np.sort(rng.integers(0, 1 << 64, 3000, dtype=np.uint64))
    assert (bloom_lm.unmixed(bloom_lm.mixed(h)) == h).all()
    # Out of order below the bits that name the slice, as pairs may be.
    h[11] = h[10] - np.uint64(1)
    for slices in (1, 7, 5000):
        sent = pa.Table.from_batches([bloom_lm._gram_rows(PAIRS, 5, h, np.arange(3000), slices)])
        assert (np.diff(sent.column("key").to_numpy()) >= 1).all() and len(sent) <= slices
        got, begin = bloom_lm._hashes_of(sent)
        assert (got == h).all() and begin[0] == 0 and len(begin) == len(sent)
        own = np.repeat(sent.column("key").to_numpy(), np.diff(np.append(begin, 3000)))
        assert (own == bloom_lm.slice_of(h, slices)).all()
    part = bloom_lm._hashes_of(pa.Table.from_batches([bloom_lm._gram_rows(PAIRS, 5, h, np.arange(3000), 50)]).slice(20, 5))
    assert len(part[1]) == 5 and (part[0] == h[bloom_lm.slice_of(h, 50) // 5 == 4]).all()
    numbers = np.array([0, 1, 255, 256, 70_000, 1 << 31])
    assert (bloom_lm._unpacked(bloom_lm._packed(numbers), 6) == numbers).all()
