"""How many short repeats of lines the chunks of line_dedup find."""

from __future__ import annotations

import random

from tallybrook.llm import line_dedup


def found(length: int, trials: int = 2000) -> int:
    """Repeats of so many lines, between other lines, of which a chunk goes."""
    rng = random.Random(length)
    new = lambda n: [b"%x" % rng.getrandbits(64) for _ in range(n)]
    hits = 0
    for _ in range(trials):
        run = new(length)
        sides = [new(rng.randrange(5, 15)) + run + new(8) for _ in range(2)]
        a, b = ({tuple(t[i:j]) for i, j in line_dedup.chunks(t, 3, 2, 64) if j - i > 1} for t in sides)
        hits += bool(a & b)
    return hits


def test_short_repeats_are_found():
    assert found(2) > 120  # 195 of 2,000; 40 with cuts at one place in three
    assert found(5) > 800  # 1,050; 527
