"""Rows without a partner, which need no details."""

import random

from skylag.llm import ngram_join
from skylag.llm.common import _with_partners


def test_rows_out_of_reach_are_dropped(spark):
    """They went through the last join with the counts of their parts."""
    rng = random.Random(4)
    sizes = [(b, rng.choice([20, 21, 40, 100, 104, 300]), rng.randrange(3), rng.randrange(4)) for b in range(40) for _ in range(5)]
    rows = [(b, k, n << 32 | place, grp) for k, (b, n, place, grp) in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "bucket long, node long, mark long, grp long")
    test = ngram_join._lengths_apart(90)
    kept = _with_partners(frame, lambda x, y: f"({test.replace('x,', f'{x},').replace('y,', f'{y},')})")
    kept = {r.node for r in kept.collect()}

    def near(a, b):
        return 10 * min(sizes[a][1], sizes[b][1]) >= 9 * max(sizes[a][1], sizes[b][1])

    met = {(a, b) for a in range(len(sizes)) for b in range(len(sizes)) if a != b and sizes[a][0] == sizes[b][0] and near(a, b)}
    assert {a for a, b in met if sizes[a][3] != sizes[b][3]} <= kept <= {a for a, _ in met} and len(kept) < len(rows)
