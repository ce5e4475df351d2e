"""Long lines compared by Spark alone, and words found instead of split."""

import random

from pyspark.sql import functions as F

from skylag.llm import line_dedup


def test_long_lines_need_no_python(spark, monkeypatch):
    """Pairs that may differ in over 1024 edits went to Python."""
    monkeypatch.setattr(line_dedup, "_long_links", lambda pairs: 1 / 0)
    rng = random.Random(15)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]

    def changed(share):
        return [w if k < 1500 or rng.random() > share else w[::-1] for k, w in enumerate(words)]

    texts = [" ".join(w) for w in (words, changed(0.5), [*words[:1500], *["z" * 9] * 900])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(frame, 63, 63).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_edits_are_tried_in_steps(spark):
    """Each number of edits that is tried decides as one test of the largest does."""
    rng = random.Random(2)
    rows = []
    for n in (0, 1, 30, 400, 6000):
        one = "".join(rng.choice("abcdé") for _ in range(n))
        rows += [(one, "".join(c if rng.random() > share else "xyz"[: rng.randrange(3)] for c in one)) for share in (0, 0.05, 0.3, 0.9)]
    frame = spark.createDataFrame(rows, "ta string, tb string").withColumn("most", F.expr("greatest(length(ta), length(tb)) div 5"))
    got = frame.selectExpr(f"{line_dedup._near('ta', 'tb', 'most')} AS near", "levenshtein(ta, tb) <= most AS want").collect()
    assert all(r.near == r.want for r in got) and {r.want for r in got} == {True, False}


def test_words_are_runs_of_letters_and_digits(spark):
    lines = ["", " ", "...", "a", " Éa-b_c 1２ ", "x\ty", "ﬀ𝐀é́z", "日本 語。", None]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    split = r"array_remove(split(lower(line), '[^\\p{L}\\p{N}]+'), '')"
    assert [r[0] for r in frame.selectExpr(line_dedup.NORMAL_WORDS).collect()] == [r[0] for r in frame.selectExpr(split).collect()]
