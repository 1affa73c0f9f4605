"""Pairs of lines are ruled out by sketches, and tried all together after one star round."""

import random

import numpy as np

from swathbook.llm import near_lines
from swathbook.llm.components import linked


def _shingles(line, width):
    return {line[i : i + width] for i in range(max(1, len(line) - width + 1))}


def _pairs():
    rnd = random.Random(11)
    for size in (1, 2, 7, 8, 9, 40, 100, 300, 3000):
        for _ in range(40):
            one = "".join(rnd.choices("abcdefg hij", k=size))
            two = list(one)
            for _ in range(rnd.randrange(1 + size // 12)):
                two[rnd.randrange(size)] = rnd.choice("äxyz")
            yield one, "".join(two) + rnd.choice(["", "a"])


def test_sketches_differ_in_no_more_bits_than_lines_in_shingles():
    one, two = map(list, zip(*_pairs(), strict=True))
    for width in (near_lines.WIDTH, near_lines.FINE):
        (n, a), (m, b) = near_lines.odd_sketches(one, width), near_lines.odd_sketches(two, width)
        for i, (x, y) in enumerate(zip(one, two, strict=True)):
            p, q = _shingles(x, width), _shingles(y, width)
            bits = sum(int(w).bit_count() for w in (a[i] ^ b[i]).view(np.uint64))
            assert (n[i], m[i]) == (len(p), len(q)) and bits <= len(p ^ q)


def test_pairs_checked_together_are_those_of_sets():
    one, two = map(list, zip(*_pairs(), strict=True))
    for width in (near_lines.WIDTH, near_lines.FINE):
        want = [len(_shingles(x, width) & _shingles(y, width)) >= 0.8 * len(_shingles(x, width) | _shingles(y, width)) for x, y in zip(one, two, strict=True)]
        assert list(near_lines._near(one, two, 0.8, width)) == want and 0 < sum(want) < len(want)


def test_pairs_are_tried_at_once_after_one_star_round(spark):
    # a chain in one bucket: a star round links the first node with the second only
    buckets, calls = spark.range(14).selectExpr("id AS node", "CAST(7 AS BIGINT) AS key"), []

    def verify(pairs):
        calls.append(pairs.count())
        return pairs.where("a - b = 1")

    got = {r["node"]: r["root"] for r in linked(buckets, verify, at_once=8).collect()}
    assert got == dict.fromkeys(range(14), 0)
    assert len(calls) == 2 and sum(calls) <= 14 * 13 // 2
