"""The suffix arrays of the shards."""

import numpy as np

from skylag.llm import suffix_dedup


def test_names_of_substrings():
    """Equal neighbours share a number, also where they are longer than what is compared at once."""
    text = np.array([1, 2, 3] * 100 + [1, 2, 3] * 99 + [1, 2, 4] + [5, 1, 0])
    starts, stops = np.array([0, 300, 0, 300, 300, 600]), np.array([200, 500, 300, 600, 601, 602])
    assert suffix_dedup.named(text, starts, stops).tolist() == [0, 0, 1, 2, 3, 4]


def test_suffix_array_of_long_runs():
    for s in ([1] * 300 + [2, 1] * 200 + [1, 1, 2] * 150, [3, 1, 2, 2] * 120, [], [1], [2, 1]):
        s = [*s, 0]
        assert list(suffix_dedup.induced_order(s, 4)) == sorted(range(len(s)), key=lambda k: s[k:])
