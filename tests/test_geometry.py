import random

import pytest
from pyspark.sql import functions as F

from swathbook.functions import geometry as G
from slabs import covered_area
from swathbook.operators import sea as SEA


def values(spark, rows, schema, *columns):
    return spark.createDataFrame(rows, schema).select(*columns).collect()


def star(rnd, cx, cy, n=7):
    import math

    pts = []
    for k in range(n):
        r, a = rnd.uniform(1, 4), 2 * math.pi * k / n
        pts.append((cx + r * math.cos(a), cy + r * math.sin(a)))
    pts.append(pts[0])
    return "POLYGON((" + ",".join(f"{x} {y}" for x, y in pts) + "))"


def test_common_area_in_the_jvm_equals_the_slab_method(spark):
    rnd = random.Random(1)
    rows = [(star(rnd, 0, 0), star(rnd, rnd.uniform(-3, 3), rnd.uniform(-3, 3))) for _ in range(25)]
    parsed = spark.createDataFrame(rows, "a string, b string").select(
        G.geometry_from_wkt("a").alias("a"), G.geometry_from_wkt("b").alias("b")
    )
    for r in parsed.select("a", "b", G.overlap_area("a", "b").alias("area"), G.area("a").alias("own")).collect():
        assert r.area == pytest.approx(covered_area(r.a.rings, r.b.rings), abs=1e-9)
        assert r.own == pytest.approx(covered_area(r.a.rings), abs=1e-9)


def test_union_of_overlapping_parts(spark):
    wkt = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((1 0, 3 0, 3 2, 1 2, 1 0)))"
    g = values(spark, [(wkt,)], "w string", G.geometry_from_wkt("w"))[0][0]
    assert covered_area(g.rings) == pytest.approx(6.0)


CASES = [
    ("POLYGON((0 0,4 0,4 4,0 4,0 0))", "POINT (4 2)", True),
    ("POLYGON((0 0,4 0,4 4,0 4,0 0))", "POINT (4.1 2)", False),
    ("POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,3 1,3 3,1 3,1 1))", "POINT (2 2)", False),
    ("POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,3 1,3 3,1 3,1 1))", "POLYGON((1.5 1.5,2 1.5,2 2,1.5 1.5))", False),
    ("POLYGON((0 0,4 0,4 4,0 4,0 0))", "POLYGON((1 1,2 1,2 2,1 1))", True),
    ("POLYGON((1 1,2 1,2 2,1 1))", "POLYGON((0 0,4 0,4 4,0 4,0 0))", True),
    ("POLYGON((0 0,4 0,0 4,0 0))", "POLYGON((3 3,4 3,4 4,3 3))", False),
    ("POLYGON((0 0,4 0,0 4,0 0))", "POLYGON((4 0,5 0,5 1,4 0))", True),
]


def test_intersects(spark):
    parsed = spark.createDataFrame(CASES, "a string, b string, want boolean").select(
        G.geometry_from_wkt("a").alias("a"), G.geometry_from_wkt("b").alias("b"), "want"
    )
    for r in parsed.select("want", G.intersects("a", "b").alias("got")).collect():
        assert r.got == r.want


def test_validity_and_repair(spark):
    rows = [
        ("POLYGON((0 0,2 0,2 2,0 2,0 0))", True, True),
        ("POLYGON((0 0,2 2,2 0,0 2,0 0))", False, False),
        ("POLYGON((0 0,0 2,0 2,2 2,2 0))", False, True),
    ]
    parsed = spark.createDataFrame(rows, "w string, valid boolean, mended boolean").withColumn("g", G.geometry_from_wkt("w"))
    for r in parsed.select("*", G.is_valid("g").alias("v"), G.repair("g").alias("r")).collect():
        assert (r.v, r.r.repaired) == (r.valid, r.mended)


def test_footprint_text(spark):
    rows = [("SRID=4326;POLYGON((0 0, 1 0, 1 1, 0 1, 0 0)))",), ("geography'SRID=4326;POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))'",), ("x",)]
    got = values(spark, rows, "f string", G.geometry_from_wkt(G.footprint_wkt("f")).alias("g"))
    assert [r.g is not None for r in got] == [True, True, False]


@pytest.mark.parametrize("broadcast_points", [1000, 0])
def test_sea_percent(spark, broadcast_points):
    """Half land, all land, all sea, two parts of which one is land, and a copy; both join paths."""
    prod = spark.createDataFrame(
        [
            ("half", "g;POLYGON ((-1 0, 1 0, 1 2, -1 2, -1 0))'"),
            ("land", "g;POLYGON ((1 1, 2 1, 2 2, 1 1))'"),
            ("sea", "g;POLYGON ((-50 1, -49 1, -49 2, -50 1))'"),
            ("parts", "g;MULTIPOLYGON (((1 1, 2 1, 2 2, 1 2, 1 1)), ((-2 1, -1 1, -1 2, -2 2, -2 1)))'"),
            ("copy", "g;POLYGON ((1 1, 2 1, 2 2, 1 1))'"),
        ],
        "Id string, Footprint string",
    )
    land = spark.createDataFrame([("a", "POLYGON((0 0,40 0,40 40,0 40,0 0))"), ("b", "junk")], "land_id string, wkt string")
    percent = SEA.footprint_sea_percent(prod, land, max_broadcast_points=broadcast_points)
    got = {r.Id: r.sea_percent for r in prod.join(percent, "Footprint").collect()}
    assert got == pytest.approx({"half": 50.0, "land": 0.0, "sea": 100.0, "parts": 50.0, "copy": 0.0})
    kept = SEA.with_sea_percent(prod, land, 50.0, rows_per_slot=1).select("Id").collect()
    assert sorted(r.Id for r in kept) == ["half", "parts", "sea"]
