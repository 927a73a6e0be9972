"""Gradients summed by runs of a like length."""

import numpy as np

from tallybrook.llm import lm


def test_sums_are_those_of_reduceat_to_the_bit():
    rng = np.random.default_rng(6)
    lengths = rng.permutation([*range(1, 140), 1, 2, 3, 9, 128, 129, 130, 300, 1111])
    for some in (lengths, lengths[:1], np.ones(5, int), np.array([129]), np.array([9, 10]), np.array([400, 2])):
        values = rng.normal(size=(200, lm.CLASSES)).astype(np.float32)
        of, first = rng.integers(0, 200, some.sum()), np.cumsum(some) - some
        total, order = lm.sums_of(values, of, first)
        assert np.array_equal(total, np.add.reduceat(np.ascontiguousarray(values[of].T), first, axis=1).T[order])
        assert sorted(order.tolist()) == list(range(len(some)))
