import json

from swathbook.operators import presence as PR
from swathbook.plans import fixtures as X
from swathbook.sources import readers as RD
from swathbook.sources import writers as WR
from swathbook.streaming import incremental as INC

NAMES = [
    "S1A_IW_GRDH_1SDV_20240101T120000_20240101T120025_052000_064000_1234.SAFE",
    "S1A_IW_GRDH_1SDV_20240102T120000_20240102T120025_052001_064001_1235.SAFE",
    "S1A_IW_GRDH_1SDV_20240103T120000_20240103T120025_052002_064002_1236.SAFE",
]


def product(i, name):
    return {
        "Id": str(i), "Name": name, "ContentLength": 1000, "Collection": {"Name": "SENTINEL-1"},
        "ContentDate": {"Start": "2024-01-01T12:00:00.000Z", "End": "2024-01-01T12:00:25.000Z"},
        "ModificationDate": "2024-01-02T00:00:00.000Z", "Footprint": "geography'SRID=4326;POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))'",
        "S3Path": "/eodata/x", "Attributes": [{"Name": "cloudCover", "Value": 12.5}, {"Name": "operationalMode", "Value": "IW"}],
    }


def test_documents_and_catalog(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text(json.dumps({"value": [product(0, NAMES[0]), product(1, NAMES[1])]}, indent=1))
    (docs / "b.json").write_text(json.dumps({"detail": "busy"}))
    (docs / "c.json").write_text(json.dumps({"value": []}))
    catalog = RD.read_catalog_json(spark, str(docs))
    assert catalog.count() == 2 and catalog.filter("content_start = '2024-01-01 12:00:00'").count() == 2
    WR.write_catalog(catalog, str(tmp_path / "cat"))
    stored = RD.read_catalog(spark, str(tmp_path / "cat"))
    assert {r.operationalMode for r in stored.collect()} == {"IW"}
    WR.write_products(catalog, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["Id", "Name", "S3Path", "geometry", "Checksum"]
    WR.write_products(catalog.limit(0), str(tmp_path / "none"))
    assert any("Id,Name" in p.read_text() for p in (tmp_path / "none").glob("*.csv"))


def test_streamed_catalog_continues(spark, tmp_path):
    docs = tmp_path / "in"
    docs.mkdir()
    for i in range(2):
        (docs / f"{i}.json").write_text(json.dumps({"value": [product(i, NAMES[i])]}))
        INC.ingest_catalog(spark, str(docs), str(tmp_path / "cat"), str(tmp_path / "chk")).awaitTermination()
        assert RD.read_catalog(spark, str(tmp_path / "cat")).count() == i + 1


def test_streamed_match_continues_after_a_batch_without_names(spark, sf, tmp_path):
    listings, catalog = tmp_path / "in", X.catalog(spark, sf)
    listings.mkdir()
    name = catalog.filter("Name LIKE '%_SLC__1S%'").first()["Name"]
    for i, text in enumerate(["\n\n", f"{name}\n", f"{name}\n"]):
        (listings / f"{i}.txt").write_text(text)
        INC.match_new_listings(spark, str(listings), catalog, "GRDH", str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    assert [r["source_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [name]


def test_features_and_listings(spark, tmp_path):
    f = tmp_path / "f.json"
    feature = {"id": "x", "properties": {"title": NAMES[0]}}
    f.write_text(json.dumps({"features": [feature, feature]}))
    assert RD.read_feature_json(spark, str(f)).count() == 2 and RD.read_feature_json(spark, str(f), distinct=True).count() == 1
    plain = tmp_path / "l.txt"
    plain.write_text(f"  {NAMES[0]} \n\n{NAMES[1]}\n")
    assert [r.safename for r in RD.read_name_listing(spark, str(plain)).orderBy("line_no").collect()] == NAMES[:2]
    assert not RD.listing_format_ok(spark, str(plain))
    head = tmp_path / "h.txt"
    head.write_text(f"id,safename,S3Path\n1,{NAMES[0]},p\n")
    assert RD.listing_format_ok(spark, str(head))
    assert RD.load_listing_for_transfer(spark, str(head)).first().S3Path == "p"
    guessed = RD.load_listing_for_transfer(spark, str(plain)).collect()
    assert guessed[0].S3Path.startswith("Sentinel-1/SAR/IW_GRDH_1S/2024/01/")


def test_presence_tiers(spark):
    listing = spark.createDataFrame([(i, f"id{i}", n) for i, n in enumerate(NAMES)], "line_no long, id string, safename string")
    files = spark.createDataFrame(
        [
            ("/arch/sentinel-1a/L1/IW/S1A_IW_GRDH_1S/2024/001/" + NAMES[0] + ".zip",),
            ("/spool/" + NAMES[0],),
            ("/spool/" + NAMES[1].replace(".SAFE", ".zip"),),
        ],
        "path string",
    )
    located = PR.locate(listing, files, ["/arch"], ["/spool"], "/out")
    assert [r.tier for r in located.orderBy("line_no").collect()] == ["archive", "spool", "absent"]
    counters = {r.counter: r.n for r in PR.presence_summary(located).collect()}
    assert counters["preproc-archived_product"] == counters["preproc-in_spool_product"] == 1
    assert counters["preproc-archive_-arch-sentinel-1a"] == 1
    todo = PR.download_listing(located).collect()
    assert [(r.safe, r.id) for r in todo] == [(NAMES[2], "id2")]


def test_fixture_listing_has_all_kinds(spark, sf):
    names = X.listing(spark, sf)
    for test in ("safename LIKE 'S1C%'", "safename LIKE '%BAD%'", "safename LIKE '/%'", "safename LIKE '%CORRUPTED'"):
        assert names.filter(test).count() > 0
