"""Searches by name: whole names and parts of names have their own joins; the listing chain; written-out world areas."""

import re

import pytest
from pyspark.sql import functions as F

from swathbook.operators import requests as R
from swathbook.operators import resolve as RS
from swathbook.operators import search as S
from swathbook.plans import lifecycle as L
from swathbook.plans import registry
from swathbook.sources import readers

ONE = "S1A_IW_SLC__1SDV_20240105T060000_20240105T060025_052000_064C3E_1234.SAFE"
TWO = "S1B_EW_GRDH_1SSH_20240207T070000_20240207T070025_052111_064D4F_5678.SAFE"
WORLD = "POLYGON((-180 -90, 180 -90, 180 90, -180 90, -180 -90))"


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        ("1", ONE, "IW", "IW_SLC__1S", "2024-01-05 06:00:00", "2024-01-06 00:00:00", 10),
        ("2", ONE, "IW", "IW_SLC__1S", "2024-01-05 06:00:00", "2024-01-09 00:00:00", 10),
        ("3", TWO, "EW", "EW_GRDH_1S", "2024-02-07 07:00:00", "2024-02-08 00:00:00", 60),
        ("4", f"copy_of_{TWO}.old", "EW", "EW_GRDH_1S", "2024-02-07 07:00:00", "2024-02-08 00:00:00", 60),
        ("5", None, "EW", "EW_GRDH_1S", "2024-02-07 07:00:00", "2024-02-08 00:00:00", 60),
    ]
    df = spark.createDataFrame(rows, "Id string, Name string, mode string, type string, content_start string, ModificationDate string, x int")
    ring = F.format_string("geography'SRID=4326;POLYGON ((%d 0, %d 0, %d 1, %d 1, %d 0))'", "x", F.col("x") + 1, F.col("x") + 1, "x", "x")
    attribute = lambda n, c: F.struct(F.lit(n).alias("Name"), F.col(c).alias("Value"))
    return df.select(
        "Id", "Name", F.lit("SENTINEL-1").alias("collection"), F.col("content_start").cast("timestamp"),
        F.col("ModificationDate").cast("timestamp"), ring.alias("Footprint"), F.concat(F.lit("/eodata/x/"), "Id").alias("S3Path"),
        F.array(attribute("operationalMode", "mode"), attribute("productType", "type")).alias("Attributes"),
    )


def found(spark, catalog, rows, **more):
    req = spark.createDataFrame(rows, "request_key string, name string, start_datetime string, end_datetime string, geometry string, sensormode string")
    return sorted((r.request_key, r.Id) for r in S.search(R.normalize_requests(req), catalog, **more).collect())


REQUESTS = [
    ("whole", ONE, None, None, None, None),
    ("whole window", ONE, "2024-01-05 05:00:00", "2024-01-05 07:00:00", None, "IW"),
    ("whole elsewhere", ONE, None, None, "POLYGON((50 0,51 0,51 1,50 1,50 0))", None),
    ("whole too late", ONE, "2024-01-06 00:00:00", None, None, None),
    ("whole other mode", ONE, None, None, None, "EW"),
    ("inside", TWO, None, None, WORLD, None),
    ("part", "_064D4F_", None, None, None, None),
    ("part of both", "SAFE", None, None, None, None),
    ("part in window", "_0520", "2024-01-01 00:00:00", "2024-01-31 00:00:00", None, None),
    ("part nowhere", "_999999_", None, None, None, None),
    ("no name", None, "2024-02-01 00:00:00", None, None, None),
    ("regular .*", "S1A_.*_1234.SAFE", None, None, None, None),
]
WANT = [
    ("inside", "3"), ("inside", "4"), ("no name", "3"), ("no name", "4"), ("no name", "5"), ("part", "3"), ("part", "4"), ("part in window", "1"),
    ("part in window", "2"), ("part of both", "1"), ("part of both", "2"), ("part of both", "3"), ("part of both", "4"), ("whole", "1"), ("whole", "2"),
    ("whole window", "1"), ("whole window", "2"),
]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
def test_classes(spark, catalog, strategy):
    """All classes of requests in one search, and each alone, find what ``contains`` finds."""
    assert found(spark, catalog, REQUESTS, strategy=strategy) == WANT
    if strategy == "auto":
        for word in ("whole", "part", "no"):
            rows = [r for r in REQUESTS if r[0].startswith(word)]
            assert found(spark, catalog, rows) == [w for w in WANT if w[0].startswith(word)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plans(spark, catalog):
    """Whole names join by name and make no day or cell keys; parts do not meet every product."""
    req = spark.createDataFrame([("a", ONE, WORLD), ("b", TWO, None)], "request_key string, name string, geometry string")
    whole = plan_of(S.search(R.normalize_requests(req), catalog))
    assert "_bucket" not in whole and "_cx" not in whole and re.search(r"Join Inner.*_whole", whole)
    req = spark.createDataFrame([(str(i), f"_{i:06d}_") for i in range(500)], "request_key string, name string")
    parts = plan_of(S.search(R.normalize_requests(req), catalog))
    assert "_bucket" not in parts and "_gram" in parts and "Cross" not in parts
    for join in re.findall(r"Join Inner.*", parts):
        assert " = " in join  # no join compares all names with all parts


def test_many_parts(spark):
    """Two thousand parts against a few thousand names, each checked by brute force."""
    names = [f"S1A_IW_SLC__1SDV_{i % 700:06d}_{(i * 7919) % 100003:06d}_X" for i in range(3000)]
    catalog = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "Id string, Name string").select(
        "Id", "Name", F.lit("C").alias("collection"), F.lit("2024-01-01").cast("timestamp").alias("content_start"), F.lit(None).cast("string").alias("Footprint"),
        F.array().cast("array<struct<Name:string,Value:string>>").alias("Attributes"),
    )
    parts = [f"_{(i * 7919) % 100003:06d}_X" if i % 2 else f"_{i % 900:06d}_" for i in range(2000)]
    req = spark.createDataFrame([(str(i), p) for i, p in enumerate(parts)], "request_key string, name string")
    got = sorted((int(r.request_key), int(r.Id)) for r in S.search(R.normalize_requests(req), catalog).collect())
    assert got == sorted((i, j) for i, p in enumerate(parts) for j, n in enumerate(names) if p in n)


def test_written_out_world(spark):
    req = spark.createDataFrame([("a", WORLD), ("b", None), ("c", "POLYGON((0 0,1 0,1 1,0 0))")], "request_key string, geometry string")
    got = {r.request_key: (r.is_world, r.area_kind) for r in R.normalize_requests(req).collect()}
    assert got == {"a": (True, "none"), "b": (True, "none"), "c": (False, "polygon")}


def test_listing_chain(spark, catalog, tmp_path):
    """Listing to requests to search to ids; repeated lines, unreadable names and units with other product types."""
    listing = spark.createDataFrame([(3, ONE), (1, TWO), (2, ONE), (4, "S1A_x.SAFE"), (5, None), (6, ONE.replace("1234", "9999"))], "line_no long, safename string")
    rows = {(r.line_no, r.id, r.safename, r.S3Path) for r in RS.search_listing(listing, catalog).collect()}
    assert rows == {(2, "2", ONE, "x/2"), (1, "3", TWO, "x/3")} or rows == {(2, "2", ONE, "x/2"), (1, "3", TWO, "x/3"), (1, "4", TWO, "x/4")}
    assert {r.id for r in RS.search_listing(listing, catalog, private_units=["S1A"]).collect()} == {"3"}
    requests = R.requests_from_names(listing)
    assert sorted(r.request_key for r in requests.collect()) == ["1", "2", "3", "6"]
    result = L.fetch_data(requests, catalog)  # a listing's requests are a request table
    assert {r.Id for r in result.collect()} == {"2", "3", "4"} and "repaired" in result.columns
    with open(f"{tmp_path}/names.txt", "w") as out:
        out.write(f"{ONE}\n{TWO}\n")
    loaded = readers.load_listing_for_transfer(spark, f"{tmp_path}/names.txt", catalog, private_units=["S1A"])
    assert [(r.id, r.safename) for r in loaded.collect()] == [("3", TWO)]
    unnumbered = R.requests_from_names(listing.drop("line_no"))
    assert sorted(r.request_key for r in unnumbered.collect()) == sorted([ONE, TWO, ONE.replace("1234", "9999")])


def test_registered():
    assert {"listing_search", "search_name_parts"} <= set(registry.ORACLE)
