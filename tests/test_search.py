import datetime as dt

import pytest
from pyspark.sql import functions as F

from swathbook.operators import requests as R
from swathbook.operators import search as S
from swathbook.operators.skew import grid_join, skew_join
from swathbook.plans import fixtures as X
from swathbook.plans import lifecycle as L

REQ = "request_key string, id_query string, start_datetime string, end_datetime string, geometry string, collection string"


def test_two_ids_get_the_same_products_and_slanted_areas_match_brute_force(spark, sf):
    catalog = X.skewed_catalog(spark, sf)
    area = "POLYGON((-60 -40, 80 -20, 40 60, -50 30, -60 -40))"
    req = spark.createDataFrame(
        [("0", "t1", "2024-01-05", "2024-01-20", area, "SENTINEL-1"), ("1", "t2", "2024-01-05", "2024-01-20", area, "SENTINEL-1")],
        REQ,
    )
    found = {k: L.fetch_data(req, catalog).filter(F.col("id_original_query") == k).select("Id").collect() for k in ("t1", "t2")}
    from swathbook.functions import geometry as G

    brute = S.latest_versions(
        S.with_geometry(catalog).filter("content_start > '2024-01-05' AND content_start < '2024-01-20'")
        .withColumn("a", G.geometry_from_wkt(F.lit(area))).filter(G.intersects("geom", "a"))
    )
    want = sorted(r.Id for r in brute.select("Id").collect())
    assert want and sorted(r.Id for r in found["t1"]) == want == sorted(r.Id for r in found["t2"])


def test_broadcast_and_shuffle_paths_agree(spark, sf):
    req, catalog = X.requests(spark, sf), X.catalog(spark, sf)
    a = S.search(req, catalog, strategy="broadcast").select("request_key", "Id")
    b = S.search(req, catalog, strategy="shuffle", rows_per_slot=200).select("request_key", "Id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_large_request_tables_avoid_nested_loops(spark, sf):
    plan = S.search(X.requests(spark, sf), X.catalog(spark, sf), strategy="shuffle")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_bad_requests_raise(spark, sf):
    row = ("0", "q", None, None, None, None)
    with pytest.raises(IndexError):
        R.check_requests(spark.createDataFrame([row, row], REQ))
    crossed = ("1", "q", None, None, "POLYGON((0 0,2 2,2 0,0 2,0 0))", None)
    with pytest.raises(ValueError):
        R.check_requests(spark.createDataFrame([row, crossed], REQ))
    empty = spark.createDataFrame([], REQ)
    assert L.fetch_data(empty, X.catalog(spark, sf)).isEmpty()


def test_null_name_fails(spark, sf):
    catalog = X.catalog(spark, sf).withColumn("Name", F.lit(None).cast("string"))
    req = spark.createDataFrame([("0", None, "2024-01-05", "2024-01-06", None, None)], REQ)
    with pytest.raises(Exception, match="Name field contains null"):
        S.require_names(S.search(req, catalog)).select("Name").collect()


def test_slices_at_an_inner_boundary(spark):
    req = spark.createDataFrame([("0", "q", "2024-01-01", "2024-01-05", None, None)], REQ)
    norm = R.normalize_requests(req)
    for mode, inclusive in (("exact", True), ("reference", False)):
        got = R.slice_requests(norm, dt.timedelta(days=2), mode).orderBy("slice_no").collect()
        assert [r.slice_no for r in got] == [0, 1]
        assert got[0].end_datetime == got[1].start_datetime and got[1].start_inclusive == inclusive


def test_skew_join_equals_plain_join(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = skew_join(big, small, ["k"], how, rows_per_slot=100).select("id", "k", "v")
        want = big.join(small, "k", how).select("id", "k", "v")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_grid_join_cuts_keys_by_rows_of_both_sides_and_by_pairs(spark):
    big = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("k"))
    other = spark.range(500).select(F.when(F.col("id") % 2 > 0, 7).otherwise(F.col("id") % 60).alias("k"), (F.col("id") * 2).alias("v"))
    want = big.join(other, "k").select("id", "k", "v")
    for rows, pairs in ((100, 10**9), (10**6, 5000), (100, 300), (10**6, 10**9)):
        got = grid_join(big, other, ["k"], rows, pairs).select("id", "k", "v")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_open_windows_reach_the_ends_of_the_catalog(spark, sf):
    catalog = X.catalog(spark, sf)
    lost = catalog.limit(1).withColumn("Id", F.lit("no start")).withColumn("content_start", F.lit(None).cast("timestamp"))
    catalog = catalog.unionByName(lost)
    rows = [("all", None, None), ("from", "2024-01-10", None), ("to", None, "2024-01-10"), ("late", "2090-01-01", None)]
    req = spark.createDataFrame([(k, k, a, b, None, None) for k, a, b in rows], REQ)
    first, other = F.col("content_start") > "2024-01-10", F.col("content_start") < "2024-01-10"
    want = {"all": catalog.count(), "from": catalog.filter(first).count(), "to": catalog.filter(other).count()}
    for strategy in ("broadcast", "shuffle"):
        found = S.search(req, catalog, strategy=strategy, rows_per_slot=500, pairs_per_slot=1000)
        assert {r["request_key"]: r["n"] for r in found.groupBy("request_key").agg(F.count(F.lit(1)).alias("n")).collect()} == want
    assert S.search(req, catalog.limit(0)).isEmpty()


def test_pairs_of_many_requests_are_not_shuffled_for_their_latest_versions(spark, sf):
    catalog = X.catalog(spark, sf)
    rows = [(str(i), f"q{i % 3}", "2024-01-02", "2024-01-20", None, None) for i in range(6)]
    found = L.fetch_data(spark.createDataFrame(rows, REQ), catalog, geometry=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(Name" in plan and "hashpartitioning(id_original_query" not in plan
    inside = catalog.filter("content_start > '2024-01-02' AND content_start < '2024-01-20'")
    names = inside.groupBy("Name").agg(F.max_by("Id", "ModificationDate").alias("Id"))
    want = sorted((f"q{i}", r["Name"], r["Id"]) for r in names.collect() for i in range(3))
    assert want and sorted(map(tuple, found.select("id_original_query", "Name", "Id").collect())) == want
    # fewer pairs than products: these are shuffled instead
    few = spark.createDataFrame([("0", "q", "2024-01-05", "2024-01-07", None, None)], REQ)
    assert "hashpartitioning(id_original_query" in L.fetch_data(few, catalog, geometry=False)._jdf.queryExecution().executedPlan().toString()


def test_only_the_queries_asked_for_are_searched(spark, sf):
    catalog = X.catalog(spark, sf)
    rows = [(str(i), f"q{i}", "2024-01-05", "2024-01-08", None, None) for i in range(5)]
    req = spark.createDataFrame(rows, REQ)
    found = L.fetch_data(req, catalog, geometry=False, queries=["q1", "q3"])
    every = L.fetch_data(req, catalog, geometry=False).filter("id_original_query IN ('q1', 'q3')")
    assert sorted(r[0] for r in found.select("Id").collect()) == sorted(r[0] for r in every.select("Id").collect()) != []
    assert {r[0] for r in found.select("id_original_query").distinct().collect()} == {"q1", "q3"}
    with pytest.raises(IndexError):  # the others are checked all the same
        L.fetch_data(spark.createDataFrame([*rows, rows[0]], REQ), catalog, queries=["q1"])
