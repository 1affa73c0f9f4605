"""Components of linked pairs, with and without finer buckets, and the prefix filter, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swathbook.llm import components as C
from swathbook.llm import near_documents as N
from swathbook.llm.components import components, linked


def brute(nodes, pairs):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("fine", [False, True])
def test_linked(spark, fine):
    """A bucket of many nodes of which few are linked, chains across buckets, and a bucket of copies."""
    rng = random.Random(3)
    holds = lambda a, b: abs(a - b) == 500 or (a % 500 < 20 and b % 500 < 20 and a // 500 == b // 500)
    rows = [(n, 1) for n in range(150)] + [(n, 2) for n in range(0, 1500, 25)] + [(n, 3 + n % 500) for n in range(1500)]
    rows += [(n, 10_000 + rng.randrange(30)) for n in range(1500)]
    tried = []

    def verify(pairs):
        tried.append(pairs.count())
        return pairs.where("a - b = 500 or (a % 500 < 20 and b % 500 < 20 and a div 500 = b div 500)")

    def refine(apart):
        # every pair that can hold shares its number's rest, or lies in a group of 20
        rest = F.col("node") % 500
        group = F.when(rest < 20, -1 - F.floor(F.col("node") / 500)).otherwise(rest)
        return apart.select("node", F.explode(F.array_distinct(F.array(rest, group))).alias("key"))

    buckets = spark.createDataFrame(rows, "node long, key long")
    got = {r["node"]: r["root"] for r in linked(buckets, verify, refine if fine else None).collect()}
    shared = {}
    for n, k in rows:
        shared.setdefault(k, set()).add(n)
    pairs = {(a, b) for members in shared.values() for a in members for b in members if a > b and holds(a, b)}
    want = brute(range(1500), pairs)
    assert all(got.get(n, n) == want[n] for n in range(1500))
    if fine:
        assert sum(tried) < 20_000  # all pairs of the buckets are some 50,000


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(500), rng.randrange(500)) for _ in range(350)] + [(n, n + 1) for n in range(1000, 1200)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute(range(1300), pairs)
    assert got == {n: want[n] for n in {n for a, b in pairs if a != b for n in (a, b)}}


def test_prefix():
    """Documents at the threshold or above share a shingle of their prefixes, whatever the weights."""
    rng = np.random.default_rng(0)
    df_of = rng.integers(1, 50, 400).astype(np.uint32)
    checked = 0
    for _ in range(1500):
        one = np.sort(rng.choice(400, rng.integers(1, 40), False))
        two = np.sort(np.unique(np.concatenate([rng.choice(one, max(1, int(len(one) * rng.uniform(0.7, 1.0))), False), rng.choice(400, rng.integers(0, 6))])))
        weigh = lambda v: 1.0 + 3.0 / df_of[v]
        one, two = one.astype(np.uint64), two.astype(np.uint64)
        if N._jaccard(one, weigh(one), two, weigh(two)) >= 0.8:
            checked += 1
            p, q = (N.prefix(v, weigh(v), df_of[v], 0.8) for v in (one, two))
            assert np.intersect1d(p, q).size and p.size < one.size * 0.8 + 2
    assert checked > 300


def test_reaches():
    """At the rarest shingle that two documents at the threshold or above share, each reaches the other's weight."""
    rng = np.random.default_rng(1)
    df_of = rng.integers(1, 9, 400).astype(np.uint32)
    weigh = lambda v: 1.0 + 3.0 / df_of[v]
    checked = 0
    for _ in range(3000):
        one = np.sort(rng.choice(400, rng.integers(1, 60), False))
        two = np.sort(np.unique(np.concatenate([rng.choice(one, max(1, int(len(one) * rng.uniform(0.7, 1.0))), False), rng.choice(400, rng.integers(0, 6))])))
        one, two = one.astype(np.uint64), two.astype(np.uint64)
        if N._jaccard(one, weigh(one), two, weigh(two)) >= 0.8:
            checked += 1
            (p, pr, pw), (q, qr, qw) = (N.reaches(v, weigh(v), df_of[v], 0.8) for v in (one, two))
            first = next(k for k in p if k in q)
            assert qw <= pr[list(p).index(first)] and pw <= qr[list(q).index(first)]
    assert checked > 500


def test_family_of_texts_below_the_threshold(spark):
    """Copies of a text that are too unlike it and each other make few pairs, and the classes are those of all pairs."""
    rng = np.random.default_rng(2)
    members = {0: np.arange(100)}
    for n in range(1, 250):
        kept = rng.choice(100, 96 if n % 10 == 0 else rng.integers(80, 88), False)
        members[n] = np.concatenate([kept, 1000 + 100 * n + np.arange(100 - len(kept))])
    values, counts = np.unique(np.concatenate(list(members.values())), return_counts=True)
    df = dict(zip(values.tolist(), counts.tolist()))
    holds = lambda a, b: len(np.intersect1d(members[a], members[b])) >= 0.8 * len(np.union1d(members[a], members[b]))
    rows = []
    for n, own in members.items():
        keys, reach, weight = N.reaches(own.astype(np.uint64), np.ones(len(own)), np.array([df[int(v)] for v in own], np.uint32), 0.8)
        rows += [(n, int(k), weight, float(r)) for k, r in zip(keys, reach)]
    finer = spark.createDataFrame(rows, "node long, key long, weight double, reach double")
    tried = []

    def verify(pairs):
        tried.extend((r["a"], r["b"]) for r in pairs.collect())
        return spark.createDataFrame([(a, b) for a, b in set(tried) if holds(a, b)], "a long, b long")

    buckets = spark.createDataFrame([(n, 1) for n in members], "node long, key long")
    got = {r["node"]: r["root"] for r in linked(buckets, verify, lambda apart: finer.join(apart, "node", "left_semi")).collect()}
    want = brute(members, [(a, b) for a in members for b in members if a > b and holds(a, b)])
    assert {n: got.get(n, n) for n in members} == want
    assert len(tried) < 5 * len(members)  # all pairs are some 31,000


def test_many_pairs_left_are_tried_in_parts_and_links_spare_later_pairs(spark, monkeypatch):
    tried = []

    def verify(pairs):
        tried.append({(r["a"], r["b"]) for r in pairs.collect()})
        return pairs.where("a % 2 = b % 2")

    buckets = spark.range(60).selectExpr("id AS node", "id % 3 AS key")
    always = lambda *a, **k: (spark.createDataFrame([], "node long, root long"), spark.createDataFrame([], "a long, b long"), buckets.selectExpr("node", "key", "node AS root", "1.0D AS weight", "1.0D AS reach"))
    monkeypatch.setattr(C, "_stars", always)
    monkeypatch.setattr(C, "TRIES", 60)
    monkeypatch.setattr(C, "TRIES_A_ROW", 1)
    roots = {r["node"]: r["root"] for r in linked(buckets, verify, at_once=8).collect()}
    assert roots == {i: i % 6 for i in range(60)}  # nodes of a key and of a parity
    pairs = 3 * 20 * 19 // 2
    assert len(tried) > 2 and max(map(len, tried)) < pairs // 3 and sum(map(len, tried)) < pairs
    assert not any(x & y for i, x in enumerate(tried) for y in tried[:i])
