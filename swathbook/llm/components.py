"""Distributed union-find, and linking of nodes that share buckets; both are joins and aggregates on narrow tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swathbook.llm.shared import drop_tables, release, shuffles_for, write_table

#: Where finer buckets are at hand, star rounds go on while one in so many tries makes a link.
USEFUL = 10
#: Pairs tried together: so many for each row of their buckets, and this many at least.
TRIES_A_ROW, TRIES = 8, 200_000


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """Root (smallest node) of every node that has a link; ``links`` has the columns a and b.

    Large-star and small-star steps alternate until the links no longer change; a step is an aggregate by node and a
    join with its result, so that a node with very many links is never gathered in one task.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = write_table(edges, "links")
    state = _digest(edges)
    while state[0]:
        with shuffles_for(edges.sparkSession, 2 * state[0]):
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
            lowest = lowest.unionByName(edges.select(F.col("b").alias("a"), F.col("b").alias("m")))
            lowest = lowest.groupBy("a").agg(F.min("m").alias("m"))
            large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = large.where("a <> b").distinct()
            lowest = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            small = small.unionByName(lowest.withColumnRenamed("m", "b")).distinct()
            superseded, edges = edges, write_table(small, "links")
            drop_tables(superseded)
            before, state = state, _digest(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    found = write_table(roots, "roots")
    drop_tables(edges)
    return found


def crowded(bands: DataFrame) -> DataFrame:
    """Rows (node, key) whose key has two nodes or more, written once."""
    many = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return write_table(bands.join(many, "key").select("node", "key"), "buckets")


def crowded_once(bands: DataFrame) -> DataFrame:
    """The same as ``crowded`` for bands that are no table: they are computed once, and shuffled once, by their key."""
    counted = bands.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key")))
    return write_table(counted.where("n > 1").select("node", "key"), "buckets")


def able(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (node, key, weight, reach) that may make a pair in their key, written once.

    A row goes if no row of its key is as light as its reach or reaches its weight, and a key if all its nodes have one
    root. Both are told from one aggregate by key, so that no pair is made for it.
    """
    rooted = write_table(buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "weighed")
    for _ in range(2):
        keys = rooted.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.min("weight").alias("lightest"), F.max("reach").alias("furthest")
        )
        kept = rooted.join(keys.where("low < high"), "key").where("lightest <= reach and weight <= furthest")
        superseded, rooted = rooted, write_table(kept.select("node", "key", "weight", "reach", "root"), "weighed")
        drop_tables(superseded)
    return rooted


def unlike(buckets: DataFrame) -> DataFrame:
    """Rows (node, key, weight, reach) without the keys whose nodes are those of another key: they would make the same pairs again.

    Of such keys the one of the largest reach stays; it comes first in all its nodes, and so reaches furthest in each.
    """
    sets = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("t"), F.max("reach").alias("reach")
    )
    kept = sets.groupBy("n", "s", "t").agg(F.max_by("key", F.struct("reach", "key")).alias("key")).select("key")
    found = write_table(buckets.join(kept, "key").select("node", "key", "weight", "reach"), "buckets")
    drop_tables(buckets)
    return found


def linked(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], refine: Callable[[DataFrame], DataFrame] | None = None, at_once: int | None = None) -> DataFrame:
    """Roots (node, root) of the components of all verified pairs that share a bucket; nodes without a link are absent.

    ``verify`` gets candidate pairs (a, b) and returns those that hold. In a star round, a member of a bucket is tried
    against one node of it, the first of another component; rounds go on while buckets have several components and
    links are found. Star rounds end early when the pairs left are fewer than nodes. ``refine`` then gets the nodes (node)
    that still share a bucket with another component, and returns finer buckets (node, key) that hold every pair
    that can hold; star rounds go on in these. What is then still apart is tried pair by pair, only across
    components, so that the components are the same as if all pairs had been tried. Where these pairs are many, they are
    made and tried in parts by their first node, so that disk goes by the rows of the buckets; links of one part spare pairs of the next.

    Finer buckets may have the columns weight and reach: a pair that can hold shares a key where each node's weight is at
    most the other's reach, and is tried in no other key. Such buckets have their star rounds from the node with the
    largest reach for its weight. With ``refine``, star rounds also end when fewer than one in USEFUL tries makes a link.

    ``at_once`` is for a ``verify`` that rules out most pairs cheaply: after the first star round, pairs are tried all
    together where they are no more than so many times the rows of the buckets, or fewer than one in USEFUL tries makes a link.
    """
    none = buckets.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    roots = buckets.select("node", F.col("node").alias("root")).where("false")
    useful = 0 if refine is None and at_once is None else USEFUL
    roots, tried, held = _stars(_always(buckets), verify, roots, none, useful, at_once)
    if refine is not None:
        nodes = write_table(held.select("node").distinct(), "apart")
        finer = unlike(able(_always(refine(nodes)), roots))
        drop_tables(held, nodes)
        roots, tried, held = _stars(finer, verify, roots, tried, useful)
        drop_tables(finer)
    rows, cross = held.count(), _cross(held)
    parts = max(1, math.ceil(cross / max(TRIES, TRIES_A_ROW * rows)))
    for part in range(parts):
        mine = lambda df: df.where(F.pmod(F.xxhash64("a", F.lit(parts)), F.lit(parts)) == part)  # noqa: B023, E731
        with shuffles_for(held.sparkSession, rows):
            side = lambda node, root, weight, reach: held.select("key", F.col("node").alias(node), F.col("root").alias(root), F.col("weight").alias(weight), F.col("reach").alias(reach))  # noqa: B023, E731
            one, two = mine(side("a", "ra", "wa", "pa")), side("b", "rb", "wb", "pb")
            pairs = one.join(two, "key").where("ra <> rb and a > b and wa <= pb and wb <= pa").select("a", "b").distinct()
            pairs = write_table(pairs.join(mine(tried), ["a", "b"], "left_anti"), "pairs")
        before = roots
        found, roots = _try(pairs, roots, verify)
        drop_tables(pairs)
        if found:
            drop_tables(before)
        if part + 1 < parts:
            release(held.sparkSession)
            if found:
                superseded, held = held, _apart(held, roots, rows)
                drop_tables(superseded)
    drop_tables(held, tried)
    return roots


def _always(buckets: DataFrame) -> DataFrame:
    """Buckets with the columns weight and reach; without them, any two nodes of a key may hold."""
    return buckets if "reach" in buckets.columns else buckets.withColumn("weight", F.lit(1.0)).withColumn("reach", F.lit(1.0))


def _apart(buckets: DataFrame, roots: DataFrame, rows: int) -> DataFrame:
    """Rows (node, key, root, weight, reach) of keys whose nodes have more than one root, written once."""
    with shuffles_for(buckets.sparkSession, rows):
        rooted = buckets.select("node", "key", "weight", "reach").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        return write_table(rooted.join(open_keys, "key").select("node", "key", "root", "weight", "reach"), "open")


def _cross(held: DataFrame) -> int:
    """Pairs of nodes that share a key and not a root, counted for each key."""
    by_root = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    by_key = by_root.groupBy("key").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("cross"))
    return by_key.agg(F.sum("cross")).first()[0] or 0


def _stars(
    buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], roots: DataFrame, tried: DataFrame, useful: int = 0, at_once: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Star rounds: the roots and tried pairs after them, and the rows (node, key, root, weight, reach) of buckets still apart."""
    rows, limit = buckets.agg(F.count(F.lit(1)), F.count_distinct("node")).first()
    turn, found, held = 0, 1, None
    while True:
        with shuffles_for(buckets.sparkSession, rows):
            superseded, held = held, _apart(buckets, roots, rows)
            drop_tables(superseded)
            few = limit if at_once is None or turn == 0 else max(limit, at_once * rows)
            if not found or _cross(held) <= few:
                return roots, tried, held
            order = F.struct((F.col("weight") / F.col("reach")).alias("far"), "node") if turn < 2 else F.struct(F.xxhash64("node", F.lit(turn)).alias("far"), "node")
            pivots = held.groupBy("key").agg(F.min(F.struct(order.alias("o"), "root", "weight", "reach")).alias("p"))
            spokes = held.join(pivots, "key").where("root <> p.root and weight <= p.reach and p.weight <= reach").select("node", "p.o")
            if turn == 0:
                spokes = spokes.groupBy("node").agg(F.min("o").alias("o"))
            pairs = spokes.select("node", F.col("o.node").alias("pivot"))
            pairs = pairs.select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()
            pairs = write_table(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
            earlier, tried = tried, write_table(tried.unionByName(pairs), "tried")
            drop_tables(earlier)
        before = roots
        found, roots = _try(pairs, roots, verify)
        if found:
            drop_tables(before)
        if turn and found * useful < pairs.count():
            found = 0 if useful else found
        drop_tables(pairs)
        found = found or turn == 0
        turn += 1


def _try(pairs: DataFrame, roots: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> tuple[int, DataFrame]:
    """Number of links found, and the roots after joining the links to the roots so far.

    Verifying reads whole texts and runs in as many tasks as the session has shuffle partitions.
    """
    good = write_table(verify(pairs).select("a", "b").distinct(), "good")
    found = good.count()
    if found:
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.unionByName(good))
    drop_tables(good)
    return found, roots
