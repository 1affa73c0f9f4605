"""Registered queries: every operator over the derived tables, with its DuckDB counterpart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import geometry as G
from swathbook.functions import names as N
from swathbook.functions import paths as P
from swathbook.operators import inventory as I
from swathbook.operators import match as M
from swathbook.operators import presence as PR
from swathbook.operators import requests as R
from swathbook.operators import resolve as RS
from swathbook.operators import search as S
from swathbook.operators import sea as SEA
from swathbook.operators import transfers as T
from swathbook.plans import fixtures as X
from swathbook.plans import lifecycle as L
from swathbook.functions.polygons import with_simple_geometry
from swathbook.plans.oracle_tables import AREA, LAND_SIDES, SHAPES, clipped, matched, sql
from swathbook.sources import readers as RD
from swathbook.sources import writers as WR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return keep


def _text(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _r6(c: str | Column) -> Column:
    return F.round(c, 6)


_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def ts(c: str) -> str:
    return _TS.format(c)


# ===================================================================== search
@register(
    "search_latest",
    sql(
        ["latest"],
        """SELECT id_original_query, count(*) AS n_products, count(*) FILTER (Id LIKE '%-v2') AS n_new_versions,
           min(Name) AS first_name, max(Name) AS last_name FROM latest GROUP BY id_original_query""",
    ),
)
def search_latest(spark: SparkSession, sf: str) -> DataFrame:
    found = L.fetch_data(X.requests(spark, sf), X.catalog(spark, sf), geometry=False)
    return found.groupBy("id_original_query").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.count_if(F.col("Id").endswith("-v2")).alias("n_new_versions"),
        F.min("Name").alias("first_name"),
        F.max("Name").alias("last_name"),
    )


@register(
    "search_attr_bbox",
    sql(
        ["hits"],
        """SELECT h.id_original_query, h.request_key, h.Id FROM hits h JOIN req r ON r.request_key = h.request_key
           WHERE r.area_kind = 'polygon' OR r.cloud_max IS NOT NULL""",
    ),
)
def search_attr_bbox(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with a polygon or a numeric attribute."""
    req = R.normalize_requests(X.requests(spark, sf)).filter("area_kind = 'polygon' OR attr_name IS NOT NULL")
    return S.search(req, X.catalog(spark, sf)).select("id_original_query", "request_key", "Id")


@register(
    "search_point",
    sql(
        ["hits"],
        """SELECT h.id_original_query, h.Id, h.Name FROM hits h JOIN req r ON r.request_key = h.request_key
           WHERE r.area_kind = 'point'""",
    ),
)
def search_point(spark: SparkSession, sf: str) -> DataFrame:
    req = R.normalize_requests(X.requests(spark, sf)).filter("area_kind = 'point'")
    return S.search(req, X.catalog(spark, sf)).select("id_original_query", "Id", "Name")


@register(
    "search_shuffled",
    sql(["hits"], "SELECT request_key, count(*) AS n, min(Id) AS first_id, max(Id) AS last_id FROM hits GROUP BY request_key"),
)
def search_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The search join on its large-request-table path: both sides shuffled, hot keys split."""
    found = S.search(X.requests(spark, sf), X.catalog(spark, sf), strategy="shuffle", rows_per_slot=2000)
    return found.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("Id").alias("first_id"), F.max("Id").alias("last_id")
    )


@register(
    "search_hot_requests",
    sql(
        ["cat"],
        """SELECT CAST(c_custkey AS VARCHAR) AS request_key, count(*) AS n, min(Id) AS first_id, max(Id) AS last_id FROM customer JOIN cat
           ON content_start > TIMESTAMP '2024-01-05 00:00:00' + to_seconds(c_custkey * 53 % 86400)
           AND content_start < TIMESTAMP '2024-01-05 00:00:00' + to_seconds(c_custkey * 53 % 86400 + 600) GROUP BY 1""",
    ),
)
def search_hot_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per customer, ten minutes long and all on one day: hot on both sides of the join."""
    k = F.col("c_custkey")
    first = F.unix_seconds(F.lit("2024-01-05 00:00:00").cast("timestamp")) + k * 53 % 86_400
    req = X.table(spark, sf, "customer").select(
        k.cast("string").alias("request_key"),
        F.timestamp_seconds(first).alias("startdate"),
        F.timestamp_seconds(first + 600).alias("stopdate"),
    )
    found = S.search(req, X.catalog(spark, sf), strategy="shuffle", rows_per_slot=1000, pairs_per_slot=50_000)
    return found.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("Id").alias("first_id"), F.max("Id").alias("last_id")
    )


@register(
    "search_open_windows",
    sql(["hits"], "SELECT h.request_key, count(*) AS n, min(h.Id) AS first_id, max(h.Id) AS last_id FROM hits h JOIN req r ON r.request_key = h.request_key WHERE CAST(h.request_key AS BIGINT) % 13 = 12 OR CAST(h.request_key AS BIGINT) % 11 = 10 GROUP BY 1"),
)
def search_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Requests without a start or an end."""
    req = X.requests(spark, sf).filter("startdate IS NULL OR stopdate IS NULL")
    found = S.search(req, X.catalog(spark, sf), strategy="shuffle")
    return found.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("Id").alias("first_id"), F.max("Id").alias("last_id")
    )


def _stored_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog written to the folder that the cluster shares (checkpoint folder, else warehouse), and read back."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/catalog-{spark.sparkContext.applicationId}-{abs(hash(sf))}"
    WR.write_catalog(X.catalog(spark, sf), path, mode="overwrite")
    return RD.read_catalog(spark, path)


@register(
    "search_stored",
    sql(["hits"], "SELECT id_original_query, request_key, Id FROM hits WHERE s IS NOT NULL AND e IS NOT NULL AND (s < TIMESTAMP '2024-01-05' OR s > TIMESTAMP '2024-01-20')",
        ),
)
def search_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with closed windows against the stored catalog; months that no window touches are not read."""
    req = R.normalize_requests(X.requests(spark, sf)).filter("start_datetime IS NOT NULL AND end_datetime IS NOT NULL")
    req = req.filter("start_datetime < '2024-01-05' OR start_datetime > '2024-01-20'")
    return S.search(req, _stored_catalog(spark, sf)).select("id_original_query", "request_key", "Id")


@register(
    "search_top",
    sql(
        ["hits"],
        """SELECT id_original_query, request_key, Id, count(*) OVER (PARTITION BY request_key) = 100 AS capped
           FROM (SELECT *, row_number() OVER (PARTITION BY request_key ORDER BY content_start, Id) AS rn FROM hits) WHERE rn <= 100""",
    ),
)
def search_top(spark: SparkSession, sf: str) -> DataFrame:
    """At most 100 rows per request (the limit is the feature)."""
    found = S.search(X.requests(spark, sf), X.catalog(spark, sf), top=100)
    return found.select("id_original_query", "request_key", "Id", "capped")


@register(
    "search_counters",
    sql(
        ["hits"],
        """SELECT unnest(['product_proposed', 'answer_append', 'nodata_answer', 'capped_answer']) AS counter,
           unnest([CAST(sum(n) AS BIGINT), count(*) FILTER (n > 0), count(*) FILTER (n = 0), count(*) FILTER (n >= 1000)]) AS n
           FROM (SELECT r.request_key, count(h.Id) AS n FROM req r LEFT JOIN hits h ON h.request_key = r.request_key GROUP BY 1)""",
    ),
)
def search_counters(spark: SparkSession, sf: str) -> DataFrame:
    req = R.normalize_requests(X.requests(spark, sf))
    return S.search_counters(req, S.search(req, X.catalog(spark, sf)))


@register("missing_names", sql(["cat"], "SELECT count(*) FILTER (Name IS NULL) AS missing_names FROM cat"))
def missing_names(spark: SparkSession, sf: str) -> DataFrame:
    return S.missing_names(S.drop_missing_ids(X.catalog(spark, sf)))


@register(
    "products_per_query",
    sql(["latest"], "SELECT id_original_query, count(*) AS n_products FROM latest GROUP BY id_original_query"),
)
def products_per_query(spark: SparkSession, sf: str) -> DataFrame:
    return S.products_per_query(L.fetch_data(X.requests(spark, sf), X.catalog(spark, sf), geometry=False))


_NATION = {
    "nhits": "SELECT r.nation_query, h.* FROM hits h JOIN req r ON r.request_key = h.request_key",
    "nlatest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nation_query, Name ORDER BY modified DESC, Id) AS rn
        FROM nhits) WHERE rn = 1""",
}


@register(
    "fetch_grouped",
    sql(
        ["hits"],
        "SELECT nation_query AS id_original_query, count(*) AS n_products, min(Id) AS first_id FROM nlatest GROUP BY 1",
        _NATION,
    ),
)
def fetch_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Several requests per query id: a product found twice counts once."""
    req = X.requests(spark, sf).withColumn("id_query", F.col("nation_query"))
    found = L.fetch_data(req, X.catalog(spark, sf), geometry=False)
    return found.groupBy("id_original_query").agg(F.count(F.lit(1)).alias("n_products"), F.min("Id").alias("first_id"))


@register(
    "fetch_sliced",
    sql(
        ["hits"],
        "SELECT nation_query AS id_original_query, count(*) AS n_products, min(Id) AS first_id FROM nlatest GROUP BY 1",
        _NATION,
    ),
)
def fetch_sliced(spark: SparkSession, sf: str) -> DataFrame:
    """The same over three-day slices: exact slicing loses nothing and repeats nothing."""
    req = X.requests(spark, sf).withColumn("id_query", F.col("nation_query"))
    found = L.fetch_data(req, X.catalog(spark, sf), timedelta_slice=dt.timedelta(days=3), geometry=False)
    return found.groupBy("id_original_query").agg(F.count(F.lit(1)).alias("n_products"), F.min("Id").alias("first_id"))


_PUB = """published > TIMESTAMP '2024-01-20 00:00:00' AND Name LIKE 'S1A%' AND ptype = 'IW_GRDH_1S'"""


@register(
    "published_after",
    sql(["cat"], f"SELECT Id, Name, {ts('published')} AS published FROM cat WHERE {_PUB}"),
)
def published_after(spark: SparkSession, sf: str) -> DataFrame:
    found = S.published_after(X.catalog(spark, sf), "2024-01-20 00:00:00", "S1A", "IW_GRDH_1S")
    return found.select("Id", "Name", _text("PublicationDate").alias("published"))


@register(
    "published_after_capped",
    sql(["cat"], f"""SELECT Id, {ts('published')} AS published, (SELECT count(*) FROM cat WHERE {_PUB}) > 50 AS capped
        FROM cat WHERE {_PUB} ORDER BY published, Id LIMIT 50"""),
)
def published_after_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50; the limit is the feature."""
    found = S.published_after(X.catalog(spark, sf), "2024-01-20 00:00:00", "S1A", "IW_GRDH_1S", cap=50)
    return found.select("Id", _text("PublicationDate").alias("published"), "capped")


@register("published_after_total", sql(["cat"], f"SELECT count(*) AS total FROM cat WHERE {_PUB}"))
def published_after_total(spark: SparkSession, sf: str) -> DataFrame:
    return S.published_after_total(X.catalog(spark, sf), "2024-01-20 00:00:00", "S1A", "IW_GRDH_1S")


@register(
    "name_filters",
    sql(
        ["cat"],
        "SELECT Id, Name FROM cat WHERE Name LIKE 'S1B%' AND contains(Name, '_2024') AND contains(Name, '1SDH') AND NOT contains(Name, '_COG')",
    ),
)
def name_filters(spark: SparkSession, sf: str) -> DataFrame:
    return S.filter_names(X.catalog(spark, sf), "S1B", ["_2024", "1SDH"], ["_COG"]).select("Id", "Name")


@register(
    "common_products",
    sql(
        ["latest"],
        """SELECT count(*) FILTER (both_) AS common, count(*) FILTER (NOT both_) AS uncommon, count(*) AS total
           FROM (SELECT Id IN (SELECT Id FROM latest WHERE id_original_query = 'R3') AS both_ FROM latest WHERE id_original_query = 'R9')""",
    ),
)
def common_products(spark: SparkSession, sf: str) -> DataFrame:
    found = L.fetch_data(X.requests(spark, sf), X.catalog(spark, sf), geometry=False, queries=["R9", "R3"])
    return S.common_products(found, "R9", "R3")


# ===================================================================== requests
@register(
    "request_normalized",
    sql(
        ["req"],
        f"""SELECT request_key, id_original_query, {ts('s')} AS start_datetime, {ts('e')} AS end_datetime,
            coalesce(area_kind, 'none') AS area_kind, area_kind IS NULL AS is_world,
            CASE WHEN cloud_max IS NOT NULL THEN 'cloudCover' END AS attr_name, cloud_max AS attr_max FROM req""",
    ),
)
def request_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return R.normalize_requests(X.requests(spark, sf)).select(
        "request_key", "id_original_query", _text("start_datetime").alias("start_datetime"),
        _text("end_datetime").alias("end_datetime"), "area_kind", "is_world", "attr_name", "attr_max",
    )


@register(
    "request_validation",
    sql(["req"], "SELECT nation_query AS request_key, count(*) AS n FROM req GROUP BY 1 HAVING count(*) > 1"),
)
def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated keys when the nation is (wrongly) taken as the row key."""
    return R.duplicate_keys(X.requests(spark, sf), "nation_query")


_WORLD_SQL = "-180 -90,180 -90,180 90,-180 90,-180 -90"
_RENDER = """SELECT request_key, filter_text,
  md5('https://catalogue.dataspace.copernicus.eu/odata/v1/Products?$filter=' || filter_text || '&$top=1000&$expand=Attributes') AS fingerprint
FROM (SELECT request_key, concat_ws(' and ',
  'OData.CSC.Intersects(area=geography''SRID=4326;' || CASE
     WHEN area_kind = 'point' THEN 'POINT(' || ax || '%20' || ay || ')'')'
     WHEN area_kind = 'polygon' THEN 'POLYGON((' || ax || ' ' || ay || ',' || bx || ' ' || ay || ',' || bx || ' ' || by_ || ',' || ax || ' ' || by_ || ',' || ax || ' ' || ay || '))'')'
     ELSE 'POLYGON((' || '{world}' || '))'')' END,
  'Collection/Name eq ''' || collection || '''', 'contains(Name,''' || name_part || ''')',
  'Attributes/OData.CSC.StringAttribute/any(att:att/Name eq ''operationalMode'' and att/OData.CSC.StringAttribute/Value eq ''' || sensormode || ''')',
  'Attributes/OData.CSC.StringAttribute/any(att:att/Name eq ''productType'' and att/OData.CSC.StringAttribute/Value eq ''' || producttype || ''')',
  'ContentDate/Start gt ' || strftime(s, '%Y-%m-%dT%H:%M:%S.000Z'), 'ContentDate/Start lt ' || strftime(e, '%Y-%m-%dT%H:%M:%S.000Z'),
  CASE WHEN cloud_max IS NOT NULL THEN 'Attributes/OData.CSC.DoubleAttribute/any(att:att/Name eq ''cloudCover'' and att/OData.CSC.DoubleAttribute/Value le 40)' END
) AS filter_text FROM req)""".replace("{world}", _WORLD_SQL)


@register("request_render", sql(["req"], _RENDER))
def request_render(spark: SparkSession, sf: str) -> DataFrame:
    return R.render_requests(R.normalize_requests(X.requests(spark, sf))).select("request_key", "filter_text", "fingerprint")


_SLICE_BASE = {
    "grp": """SELECT nation_query, min(s) AS lo, max(e) AS hi,
        ceil((epoch_us(max(e)) - epoch_us(min(s))) / 259200000000.0) AS n FROM req GROUP BY nation_query""",
    "grid": """SELECT nation_query, lo, hi, i, lo + to_days(CAST(3 * i AS INTEGER)) AS b, lo + to_days(CAST(3 * i + 3 AS INTEGER)) AS f, n
        FROM (SELECT *, unnest(range(0, CAST(coalesce(n, 0) AS BIGINT))) AS i FROM grp WHERE n > 0)""",
}
_SLICE_REFERENCE = f"""
SELECT request_key, i AS slice_no, {ts("CASE WHEN e - s > INTERVAL 3 DAY THEN greatest(s, b) ELSE s END")} AS slice_start,
  {ts("CASE WHEN e - s > INTERVAL 3 DAY THEN least(e, f) ELSE e END")} AS slice_end
FROM req JOIN grid USING (nation_query)
WHERE CASE WHEN e - s > INTERVAL 3 DAY THEN greatest(s, b) <= least(e, f) ELSE s >= b AND e <= f END
UNION ALL
SELECT request_key, 0, {ts("s")}, {ts("e")} FROM req WHERE nation_query NOT IN (SELECT nation_query FROM grid)"""
_SLICE_EXACT = f"""
SELECT request_key, i AS slice_no, {ts("greatest(s, b)")} AS slice_start, {ts("least(e, f)")} AS slice_end, b > s AS start_inclusive
FROM req JOIN grid USING (nation_query) WHERE s IS NOT NULL AND e IS NOT NULL AND s < f AND e > b
UNION ALL
SELECT request_key, 0, {ts("s")}, {ts("e")}, false FROM req
WHERE nation_query NOT IN (SELECT nation_query FROM grid) OR s IS NULL OR e IS NULL"""


def _slices(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    req = X.requests(spark, sf).withColumn("id_query", F.col("nation_query"))
    out = R.slice_requests(R.normalize_requests(req), dt.timedelta(days=3), mode)
    return out.select(
        "request_key", "slice_no", _text("start_datetime").alias("slice_start"), _text("end_datetime").alias("slice_end"),
        "start_inclusive",
    )


@register("slice_reference", sql(["req"], _SLICE_REFERENCE, _SLICE_BASE))
def slice_reference(spark: SparkSession, sf: str) -> DataFrame:
    return _slices(spark, sf, "reference").drop("start_inclusive")


@register("slice_exact", sql(["req"], _SLICE_EXACT, _SLICE_BASE))
def slice_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _slices(spark, sf, "exact")


@register("unique_queries", sql(["req"], "SELECT DISTINCT nation_query AS id_original_query FROM req"))
def unique_queries(spark: SparkSession, sf: str) -> DataFrame:
    req = X.requests(spark, sf).withColumn("id_query", F.col("nation_query"))
    return R.normalize_requests(req).select("id_original_query").distinct()


# ===================================================================== names and paths
_ALL_NAMES = {"names": "SELECT Id, Name FROM cat UNION ALL SELECT 'L' || line_no, safename FROM listing"}


def _all_names(spark: SparkSession, sf: str) -> DataFrame:
    lines = X.listing(spark, sf).select(F.concat(F.lit("L"), F.col("line_no").cast("string")).alias("Id"), F.col("safename").alias("Name"))
    return X.catalog(spark, sf).select("Id", "Name").unionByName(lines)


def _cut(a: int, b: int) -> str:
    """Characters a..b-1 of a name that can be parsed, null instead of empty text."""
    return f"CASE WHEN NOT contains(Name, '/') THEN nullif(substr(Name, {a + 1}, {b - a}), '') END"


_S1_TIMES = "try_strptime(substr(Name, 18, 15), '%Y%m%dT%H%M%S') AS st, try_strptime(substr(Name, 34, 15), '%Y%m%dT%H%M%S') AS en"
_PARSE_S1 = f"""
SELECT Id, Name, {_cut(0, 3)} AS satellite, {_cut(4, 6)} AS mode, {_cut(7, 11)} AS product, {_cut(12, 13)} AS level, {_cut(13, 14)} AS kind,
  {_cut(14, 16)} AS polarisation, CASE WHEN NOT contains(Name, '/') THEN {ts('st')} END AS startdate,
  CASE WHEN NOT contains(Name, '/') THEN {ts('en')} END AS enddate,
  {_cut(49, 55)} AS absolute_orbit_number, {_cut(56, 62)} AS mission_data_take, {_cut(63, 67)} AS product_id,
  CASE WHEN NOT contains(Name, '/') THEN CAST(epoch(en) - epoch(st) AS DOUBLE) END AS duration,
  CASE WHEN NOT contains(Name, '/') THEN 'CbandRadar' END AS sensor, CASE WHEN NOT contains(Name, '/') THEN 'operational' END AS production_status,
  CASE WHEN contains(Name, '/') THEN 'full path instead of a name' WHEN st IS NULL OR en IS NULL THEN 'unreadable time' END AS parse_error
FROM (SELECT *, {_S1_TIMES} FROM names)"""


@register("parse_s1", sql(["cat", "listing"], _PARSE_S1, _ALL_NAMES))
def parse_s1(spark: SparkSession, sf: str) -> DataFrame:
    df = N.with_parsed_name(_all_names(spark, sf))
    keep = [
        "satellite", "mode", "product", "level", "kind", "polarisation", "absolute_orbit_number", "mission_data_take",
        "product_id", "duration", "sensor", "production_status", "parse_error",
    ]
    return df.select("Id", "Name", *keep, _text("startdate").alias("startdate"), _text("enddate").alias("enddate"))


@register(
    "parse_s2",
    sql(
        ["other"],
        f"""SELECT event_id, s2_name, split_part(s2_name, '_', 1) AS satellite, split_part(s2_name, '_', 2) AS product,
            substr(split_part(s2_name, '_', 2), 4) AS level, {ts('t')} AS startdate, {ts('t')} AS enddate, 'N0204' AS processing_baseline,
            CAST(g % 143 AS INTEGER) AS relative_orbit_number, split_part(s2_name, '_', 6) AS tile, {ts('t + to_seconds(1)')} AS production_date,
            strftime(t + to_seconds(1), '%Y%m%dT%H%M%S') AS product_id, CAST(0 AS DOUBLE) AS duration,
            'MultiSpectralImager' AS sensor, 'operational' AS production_status FROM other""",
    ),
)
def parse_s2(spark: SparkSession, sf: str) -> DataFrame:
    f = N.s2_fields("s2_name")
    times = ["startdate", "enddate", "production_date"]
    return X.other_mission_names(spark, sf).select(
        "event_id", "s2_name", *[(_text(c) if k in times else c).alias(k) for k, c in f.items()]
    )


@register(
    "parse_s3",
    sql(
        ["other"],
        f"""SELECT event_id, s3_name, split_part(s3_name, '_', 1) AS satellite, 'SR' AS sensor, '2' AS level, 'WAT' AS product,
            {ts('t')} AS startdate, {ts('t + to_seconds(600)')} AS stopdate, {ts('t + to_seconds(7490)')} AS enddate,
            strftime(t + to_seconds(7490), '%Y%m%dT%H%M%S') AS mission_data_take, CAST(600 AS DOUBLE) AS duration, '0600' AS product_id,
            printf('%03d', g % 100) AS cycle_number, printf('%03d', event_id % 385) AS relative_orbit_number, 'MAR' AS product_generating_center,
            CASE g % 4 WHEN 0 THEN 'operational' WHEN 1 THEN 'reference' WHEN 2 THEN 'development' ELSE 'reprocessing' END AS production_status
            FROM other""",
    ),
)
def parse_s3(spark: SparkSession, sf: str) -> DataFrame:
    f = N.s3_fields("s3_name")
    times = ["startdate", "stopdate", "enddate"]
    return X.other_mission_names(spark, sf).select(
        "event_id", "s3_name", *[(_text(c) if k in times else c).alias(k) for k, c in f.items()]
    )


@register(
    "name_expressions",
    sql(
        ["cat"],
        f"""SELECT Id, {ts('content_start')} AS start_time,
            CASE WHEN substr(Name, 8, 4) = 'GRDH' THEN {ts('content_end')} ELSE {ts('content_start')} END AS field5_time,
            CASE WHEN Name LIKE 'S1B%' THEN ptype || '_PRIVATE' ELSE ptype END AS product_type,
            CASE WHEN mode = 'EW' AND contains(Name, 'OCN') THEN 0.037 WHEN mode = 'EW' AND contains(Name, 'SLC') THEN 3.7
                 WHEN mode = 'IW' AND contains(Name, 'OCN') THEN 0.015 ELSE 0.0038 END AS volume,
            direction AS orbit_pass, 'https://zipper.dataspace.copernicus.eu/odata/v1/Products(' || Id || ')/$value' AS url, Id AS id_back,
            round(size / 1048576.0, 2) AS size_mb, substr(Name, 8, 4) AS token, CASE WHEN substr(Name, 8, 4) = 'OCN_' THEN '2' ELSE '1' END AS level
            FROM cat""",
    ),
)
def name_expressions(spark: SparkSession, sf: str) -> DataFrame:
    url = P.download_url("Id")
    kind = F.substring("Name", 8, 4)
    return X.catalog(spark, sf).select(
        "Id",
        _text(N.start_time("Name")).alias("start_time"),
        _text(N.start_time_field5("Name")).alias("field5_time"),
        N.product_type("Name", ["S1B"]).alias("product_type"),
        N.volume_tb("Name").alias("volume"),
        N.orbit_pass("Attributes").alias("orbit_pass"),
        url.alias("url"),
        P.id_from_url(url).alias("id_back"),
        N.size_mb("ContentLength").alias("size_mb"),
        N.type_token(kind).alias("token"),
        N.target_level(kind).alias("level"),
    )


@register(
    "object_paths",
    sql(
        ["cat", "other"],
        """SELECT Name AS safename, 'Sentinel-1/SAR/' || ptype || '/' || strftime(content_start, '%Y/%m/%d') || '/' || Name AS path,
             CAST(NULL AS VARCHAR) AS path_error FROM cat
           UNION ALL SELECT s2_name, 'Sentinel-2/MSI/' || substr(split_part(s2_name, '_', 2), 4) || '/' || strftime(t, '%Y/%m/%d') || '/' || s2_name, NULL FROM other
           UNION ALL SELECT s3_name, NULL, 'mission not handled' FROM other""",
    ),
)
def object_paths(spark: SparkSession, sf: str) -> DataFrame:
    other = X.other_mission_names(spark, sf)
    names = (
        X.catalog(spark, sf).select(F.col("Name").alias("safename"))
        .unionByName(other.select(F.explode(F.array("s2_name", "s3_name")).alias("safename")))
    )
    return names.select("safename", P.object_path("safename").alias("path"), P.object_path_error("safename").alias("path_error"))


@register(
    "archive_dirs",
    sql(
        ["cat"],
        """SELECT Id, '/arch/sentinel-1' || lower(substr(Name, 3, 1)) || '/L' || substr(Name, 13, 1) || '/' || mode || '/' || substr(Name, 1, 3)
             || '_' || mode || substr(Name, 7, 8) || strftime(content_start, '/%Y/%j') AS dir, '/out/' || Name || '.zip' AS output_path,
           Name AS base FROM cat""",
    ),
)
def archive_dirs(spark: SparkSession, sf: str) -> DataFrame:
    out = P.output_path("Name", "/out")
    return X.catalog(spark, sf).select(
        "Id", P.archive_dir("Name", "/arch").alias("dir"), out.alias("output_path"), P.base_name(out).alias("base")
    )


_AUDIT = """SELECT *, CASE WHEN expected_path = listed_path THEN 'OK' ELSE 'KO' END AS verdict
FROM (SELECT Name AS safename, 'Sentinel-1/SAR/' || ptype || '/' || strftime(content_start, '%Y/%m/%d') || '/' || Name AS expected_path,
  substr(S3Path, 9) AS listed_path FROM cat)"""


@register("path_audit", sql(["cat"], f"SELECT * FROM ({_AUDIT}) WHERE verdict = 'KO'"))
def path_audit(spark: SparkSession, sf: str) -> DataFrame:
    return RS.path_audit(X.catalog(spark, sf)).filter("verdict = 'KO'")


@register("path_audit_counts", sql(["cat"], f"SELECT verdict, count(*) AS n FROM ({_AUDIT}) GROUP BY verdict"))
def path_audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return RS.path_audit_counts(RS.path_audit(X.catalog(spark, sf)))


# ===================================================================== listings
@register("listing_clean", sql(["listing"], "SELECT DISTINCT safename FROM listing WHERE regexp_matches(safename, '.SAFE')"))
def listing_clean(spark: SparkSession, sf: str) -> DataFrame:
    return RD.keep_product_names(X.listing(spark, sf)).select("safename").distinct()


@register(
    "listing_requests",
    sql(
        ["src"],
        f"""SELECT 'batch_query' AS id_query, {ts("st - INTERVAL 1 SECOND")} AS start_datetime,
            {ts("strptime(substr(source_id, 34, 15), '%Y%m%dT%H%M%S') + INTERVAL 1 SECOND")} AS end_datetime,
            'SENTINEL-1' AS collection, source_id AS name, substr(source_id, 5, 2) AS sensormode,
            CASE WHEN source_id LIKE 'S1C%' THEN substr(source_id, 5, 10) || '_PRIVATE' ELSE substr(source_id, 5, 10) END AS producttype
            FROM src WHERE ok AND regexp_matches(source_id, '.SAFE')""",
    ),
)
def listing_requests(spark: SparkSession, sf: str) -> DataFrame:
    req = R.requests_from_names(X.listing(spark, sf), private_units=["S1C"])
    return req.select(
        "id_query", _text("start_datetime").alias("start_datetime"), _text("end_datetime").alias("end_datetime"),
        "collection", "name", "sensormode", "producttype",
    )


@register(
    "resolve_ids",
    sql(
        ["listing", "cat"],
        """SELECT l.line_no, c.id, l.safename, c.S3Path FROM (SELECT safename, min(line_no) AS line_no FROM listing GROUP BY safename) l
           LEFT JOIN (SELECT Name, min(Id) AS id, arg_min(replace(S3Path, '/eodata/', ''), Id) AS S3Path FROM cat GROUP BY Name) c ON c.Name = l.safename""",
    ),
)
def resolve_ids(spark: SparkSession, sf: str) -> DataFrame:
    return RS.resolve_ids(X.listing(spark, sf), X.catalog(spark, sf))


@register(
    "listing_search",
    sql(
        ["src", "cat"],
        """SELECT l.line_no, Id AS id, Name AS safename, replace(S3Path, '/eodata/', '') AS S3Path
           FROM (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY modified DESC, Id) AS rn FROM cat) c
           JOIN (SELECT source_id, min(line_no) AS line_no FROM src WHERE ok AND regexp_matches(source_id, '.SAFE') GROUP BY source_id) l
             ON c.Name = l.source_id WHERE rn = 1""",
    ),
)
def listing_search(spark: SparkSession, sf: str) -> DataFrame:
    """Listing to requests to search to ids."""
    return RS.search_listing(X.listing(spark, sf), X.catalog(spark, sf), private_units=["S1C"])


@register(
    "search_name_parts",
    sql(
        ["cat"],
        """SELECT q.request_key, c.Id FROM (SELECT CAST(n_nationkey AS VARCHAR) AS request_key,
             CASE WHEN n_nationkey % 2 = 0 THEN 'S_2024' || printf('%02d', 1 + n_nationkey % 3) || printf('%02d', 1 + n_nationkey)
               ELSE '_' || printf('%06d', 7 * n_nationkey) || '_' END AS part,
             CASE n_nationkey % 3 WHEN 1 THEN 'IW' END AS md FROM nation) q
           JOIN cat c ON contains(c.Name, q.part) AND (q.md IS NULL OR c.mode = q.md)""",
    ),
)
def search_name_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Requests for parts of names without a window."""
    n = F.col("n_nationkey")
    day = F.concat(F.lit("S_2024"), F.lpad((1 + n % 3).cast("string"), 2, "0"), F.lpad((1 + n).cast("string"), 2, "0"))
    orbit = F.concat(F.lit("_"), F.lpad((7 * n).cast("string"), 6, "0"), F.lit("_"))
    req = X.table(spark, sf, "nation").select(
        n.cast("string").alias("request_key"), F.when(n % 2 == 0, day).otherwise(orbit).alias("name"), F.when(n % 3 == 1, "IW").alias("sensormode"),
    )
    return S.search(R.normalize_requests(req), X.catalog(spark, sf)).select("request_key", "Id")


@register("odata_listing", sql(["prod"], "SELECT event_id || '-' || k AS id, Name AS safename FROM prod WHERE event_type <> 'signup'"))
def odata_listing(spark: SparkSession, sf: str) -> DataFrame:
    documents = X.response_documents(spark, sf)
    return RD.product_listing(RD.catalog_from_json_text(documents.unionByName(documents), "body"))


@register(
    "catalog_json",
    sql(
        ["prod"],
        f"""SELECT event_id || '-' || k AS Id, Name, 'SENTINEL-1' AS collection, {ts('start')} AS content_start, {ts('stop')} AS content_end,
            {ts('start + INTERVAL 1 DAY')} AS modified, CAST(floor(value * 1000000) AS BIGINT) AS ContentLength, value % 100 AS cloud_cover
            FROM prod WHERE event_type <> 'signup'""",
    ),
)
def catalog_json(spark: SparkSession, sf: str) -> DataFrame:
    c = RD.catalog_from_json_text(X.response_documents(spark, sf), "body")
    return c.select(
        "Id", "Name", "collection", _text("content_start").alias("content_start"), _text("content_end").alias("content_end"),
        _text("ModificationDate").alias("modified"), "ContentLength",
        N.attribute("Attributes", "cloudCover").try_cast("double").alias("cloud_cover"),
    )


@register(
    "feature_listing",
    sql(
        ["prod"],
        """SELECT event_id || '-' || k AS id, Name AS safename FROM
           (SELECT *, unnest(range(0, CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END)) FROM prod WHERE event_type <> 'signup')""",
    ),
)
def feature_listing(spark: SparkSession, sf: str) -> DataFrame:
    return RD.features_from_json_text(X.feature_documents(spark, sf), "body")


# ===================================================================== sibling match
def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return M.match_siblings(X.listing(spark, sf), X.catalog(spark, sf), "GRDH")


@register(
    "match_siblings",
    sql(["matched"], "SELECT * REPLACE (coalesce(delta_seconds, -1) AS delta_seconds) FROM matched"),
)
def match_siblings(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf).withColumn("delta_seconds", F.coalesce("delta_seconds", F.lit(-1)))


_DELTAS = "SELECT * REPLACE (coalesce(delta_seconds, -1) AS delta_seconds) FROM {}"


def _register_match(query: str, target: str, level: str, raw: bool = False, mode: str = "default") -> None:
    """Matches with another type than GRDH; RAW_ ones at both levels."""
    needs = ["src", "raw_cat" if raw else "cat"]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        catalog = X.raw_catalog(spark, sf) if raw else X.catalog(spark, sf)
        found = M.match_siblings(X.listing(spark, sf), catalog, target, mode=mode)
        return found.withColumn("delta_seconds", F.coalesce("delta_seconds", F.lit(-1)))

    register(query, sql(needs, _DELTAS.format("m"), {"m": matched(target, level, "raw_cat" if raw else "cat")}))(run)


_register_match("match_ocn", "OCN_", "2")
_register_match("match_slc", "SLC_", "1")
_register_match("match_raw", "RAW_", "0", raw=True)
_register_match("match_raw_reference", "RAW_", "1", raw=True, mode="reference")


@register(
    "match_report",
    sql(["matched"], "SELECT coalesce(target_name, '# NOT_FOUND: ' || source_id || ' — ' || coalesce(note, '')) AS line FROM matched"),
)
def match_report(spark: SparkSession, sf: str) -> DataFrame:
    return M.match_report(_matches(spark, sf))


@register(
    "match_delta_hist",
    sql(
        ["matched"],
        """SELECT delta_seconds AS delta, count(*) AS n, delta_seconds > 8 AS above_threshold FROM matched
           WHERE delta_seconds IS NOT NULL GROUP BY delta_seconds""",
    ),
)
def match_delta_hist(spark: SparkSession, sf: str) -> DataFrame:
    return M.match_delta_histogram(_matches(spark, sf))


@register(
    "match_summary",
    sql(
        ["matched"],
        """SELECT count(*) FILTER (status = 'found') AS found, count(*) FILTER (status = 'not_found') AS not_found,
           count(*) FILTER (status = 'error') AS errors FROM matched""",
    ),
)
def match_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.match_summary(_matches(spark, sf))


@register(
    "match_resume",
    sql(
        ["listing", "prod"],
        "SELECT line_no, safename FROM listing WHERE safename NOT IN (SELECT Name FROM prod WHERE event_type IN ('click', 'purchase'))",
    ),
)
def match_resume(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of the listing after a run that treated clicks and purchases."""
    done = X.products(spark, sf).filter(F.col("event_type").isin("click", "purchase")).select(F.col("Name").alias("source_id"))
    return M.unprocessed(X.listing(spark, sf), done)


# ===================================================================== presence
def _located(spark: SparkSession, sf: str, **options) -> DataFrame:
    return PR.locate(X.listing(spark, sf), X.files(spark, sf), X.ARCHIVES, X.SPOOLS, X.OUTDIR, **options)


@register("presence", sql(["located"], "SELECT line_no, safename, tier, found_path, to_download, output_path FROM located"))
def presence(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf)


@register(
    "presence_forced",
    sql(["located"], "SELECT tier, true AS to_download, count(*) AS n FROM located GROUP BY tier"),
)
def presence_forced(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf, force=True).groupBy("tier", "to_download").agg(F.count(F.lit(1)).alias("n"))


@register(
    "presence_summary",
    sql(
        ["located"],
        """SELECT 'products_in_initial_listing' AS counter, count(*) AS n FROM located
           UNION ALL SELECT CASE tier WHEN 'archive' THEN 'preproc-archived_product' WHEN 'spool' THEN 'preproc-in_spool_product'
             WHEN 'outdir' THEN 'preproc-in_outdir_product' ELSE 'preproc-product_absent_from_local_disks' END, count(*) FROM located GROUP BY 1
           UNION ALL SELECT 'preproc-archive_' || array_to_string(list_slice(string_split(found_path, '/'), 1, 3), '-'), count(*)
             FROM located WHERE tier = 'archive' GROUP BY 1""",
    ),
)
def presence_summary(spark: SparkSession, sf: str) -> DataFrame:
    return PR.presence_summary(_located(spark, sf))


@register("download_listing", sql(["located"], "SELECT list_last(string_split(safename, '/')) AS safe FROM located WHERE to_download"))
def download_listing(spark: SparkSession, sf: str) -> DataFrame:
    return PR.download_listing(_located(spark, sf))


# ===================================================================== inventory
def _stack_sql(value: str, zero: str = "0") -> str:
    return f"coalesce(sum({value}) OVER (PARTITION BY period ORDER BY series_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {zero})"


_SERIES = {
    "series": """SELECT u.i * 4 + p.i AS series_no, unit, polarisation FROM
      (SELECT unnest(['S1A', 'S1B']) AS unit, unnest([0, 1]) AS i) u,
      (SELECT unnest(['1SDV', '1SSV', '1SSH', '1SDH']) AS polarisation, unnest([0, 1, 2, 3]) AS i) p""",
    "months": "SELECT strftime(m, '%Y-%m') AS period, CAST(m AS TIMESTAMP) AS m FROM (SELECT unnest(generate_series(DATE '2023-10-01', DATE '2024-06-01', INTERVAL 1 MONTH)) AS m)",
    "years": "SELECT CAST(y AS VARCHAR) AS period, y FROM (SELECT unnest(range(2013, 2026)) AS y)",
    "sat": "SELECT *, substr(Name, 1, 3) AS unit, substr(Name, 13, 4) AS pl FROM cat",
}
_MONTH_STACK = f"""SELECT period, series_no, unit, polarisation, n, CAST({_stack_sql('n')} AS BIGINT) AS stack_base FROM (
  SELECT m.period, s.series_no, s.unit, s.polarisation, count(c.Id) AS n FROM months m CROSS JOIN series s
  LEFT JOIN sat c ON strftime({{start}}, '%Y-%m') = m.period AND contains(c.Name, s.unit) AND contains(c.Name, s.polarisation)
  GROUP BY ALL)"""


@register("inv_month_unit_pol", sql(["cat"], _MONTH_STACK.format(start="c.content_start"), _SERIES))
def inv_month_unit_pol(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_month(X.catalog(spark, sf), "2023-10", "2024-06")


@register(
    "inv_month_field5",
    sql(["cat"], _MONTH_STACK.format(start="CASE WHEN contains(c.Name, 'GRDH') THEN c.content_end ELSE c.content_start END"), _SERIES),
)
def inv_month_field5(spark: SparkSession, sf: str) -> DataFrame:
    """Time read from the sixth name field, as the historical figures did."""
    return I.count_per_month(X.catalog(spark, sf), "2023-10", "2024-06", mode="reference")


@register(
    "inv_climatology",
    sql(
        ["cat"],
        """SELECT CAST(month(content_start) AS INTEGER) AS month, s.unit, s.polarisation, count(*) AS n
           FROM cat c JOIN series s ON contains(c.Name, s.unit) AND contains(c.Name, s.polarisation) GROUP BY ALL""",
        _SERIES,
    ),
)
def inv_climatology(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_calendar_month(X.catalog(spark, sf))


@register(
    "inv_year_pass",
    sql(
        ["cat"],
        f"""SELECT period, series_no, unit, pass, n, CAST({_stack_sql('n')} AS BIGINT) AS stack_base FROM (
            SELECT y.period, s.series_no, s.unit, s.pass, count(c.Id) AS n FROM years y CROSS JOIN
              (SELECT unnest([0, 1, 2, 3]) AS series_no, unnest(['S1A', 'S1A', 'S1B', 'S1B']) AS unit,
                 unnest(['ASCENDING', 'DESCENDING', 'ASCENDING', 'DESCENDING']) AS pass) s
            LEFT JOIN cat c ON year(c.content_start) = y.y AND contains(c.Name, s.unit) AND contains(c.direction, s.pass) GROUP BY ALL)""",
        _SERIES,
    ),
)
def inv_year_pass(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_year_pass(X.catalog(spark, sf), 2013, 2025)


_VOLUME = """CASE WHEN contains(c.Name, 'EW') AND contains(c.Name, 'OCN') THEN 0.037::DOUBLE WHEN contains(c.Name, 'EW') AND contains(c.Name, 'SLC') THEN 3.7::DOUBLE
  WHEN contains(c.Name, 'IW') AND contains(c.Name, 'OCN') THEN 0.015::DOUBLE ELSE 0.0038::DOUBLE END"""


def _volume_sql(spine: str, match: str) -> str:
    return f"""SELECT period, series_no, unit, polarisation, round(volume, 6) AS volume, round({_stack_sql('volume', '0.0')}, 6) AS stack_base FROM (
      SELECT m.period, s.series_no, s.unit, s.polarisation, coalesce(sum(CASE WHEN c.Id IS NOT NULL THEN {_VOLUME} END), 0.0::DOUBLE) AS volume
      FROM {spine} m CROSS JOIN series s LEFT JOIN cat c ON {match} AND contains(c.Name, s.unit) AND contains(c.Name, s.polarisation) GROUP BY ALL)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("volume", _r6("volume")).withColumn("stack_base", _r6("stack_base"))


@register("inv_volume", sql(["cat"], _volume_sql("years", "year(c.content_start) = m.y"), _SERIES))
def inv_volume(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(I.volume_per_period(X.catalog(spark, sf), "year", "2013", "2025"))


@register("inv_volume_month", sql(["cat"], _volume_sql("months", "strftime(c.content_start, '%Y-%m') = m.period"), _SERIES))
def inv_volume_month(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(I.volume_per_period(X.catalog(spark, sf), "month", "2023-10", "2024-06"))


@register(
    "inv_year_pol",
    sql(
        ["cat"],
        "SELECT CAST(y AS INTEGER) AS year, "
        + ", ".join(f"count(*) FILTER (contains(Name, '{p}_' || y)) AS \"{p}\"" for p in K.POLARISATIONS)
        + " FROM years LEFT JOIN cat ON true GROUP BY y",
        _SERIES,
    ),
)
def inv_year_pol(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_year_wide(X.catalog(spark, sf), 2013, 2025)


@register(
    "inv_year_unit_pol",
    sql(
        ["cat"],
        "SELECT CAST(y AS INTEGER) AS year, "
        + ", ".join(
            f"count(*) FILTER (contains(Name, '{p}_' || y) AND contains(Name, '{u}')) AS \"{u}_{p}\"" for u in K.UNITS for p in K.POLARISATIONS
        )
        + " FROM years LEFT JOIN cat ON true GROUP BY y",
        _SERIES,
    ),
)
def inv_year_unit_pol(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_year_unit_wide(X.catalog(spark, sf), 2013, 2025)


_AVAILABLE = "SELECT CAST(y AS INTEGER) AS year, count(Id) AS all_products, count(Id) FILTER (value > 20) AS available_products FROM years LEFT JOIN cat ON {} GROUP BY y"


def _with_available(spark: SparkSession, sf: str) -> DataFrame:
    return X.catalog(spark, sf).withColumn("available", F.col("ContentLength") > 20_000_000)


_AVAILABLE = _AVAILABLE.replace("value > 20", "size > 20000000")


@register("inv_available", sql(["cat"], _AVAILABLE.format("year(content_start) = y"), _SERIES))
def inv_available(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_available_per_year(_with_available(spark, sf), "available", 2013, 2025)


@register("inv_available_text", sql(["cat"], _AVAILABLE.format("contains(Name, '_' || y)"), _SERIES))
def inv_available_text(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_available_per_year(_with_available(spark, sf), "available", 2013, 2025, mode="reference")


_MONTH30 = """SELECT m.period, s.unit, s.polarisation, count(c.Id) AS n FROM months m CROSS JOIN series s
  LEFT JOIN cat c ON {} AND contains(c.Name, s.unit) AND contains(c.Name, s.polarisation || '_') GROUP BY ALL"""


@register("inv_month30", sql(["cat"], _MONTH30.format(
    "CASE WHEN contains(c.Name, 'GRDH') THEN c.content_end ELSE c.content_start END >= m.m AND "
    "CASE WHEN contains(c.Name, 'GRDH') THEN c.content_end ELSE c.content_start END < m.m + INTERVAL 30 DAY"), _SERIES))
def inv_month30(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_month_window(X.catalog(spark, sf), "2023-10", "2024-06", mode="reference")


@register("inv_month_calendar", sql(["cat"], _MONTH30.format("strftime(c.content_start, '%Y-%m') = m.period"), _SERIES))
def inv_month_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return I.count_per_month_window(X.catalog(spark, sf), "2023-10", "2024-06")


@register(
    "footprint_census",
    sql(["cat"], "SELECT 'polygon' AS geom_type, count(*) FILTER (Id NOT LIKE '%-v2') AS n FROM cat UNION ALL SELECT 'multipolygon', count(*) FILTER (Id LIKE '%-v2') FROM cat"),
)
def footprint_census(spark: SparkSession, sf: str) -> DataFrame:
    return I.footprint_census(X.skewed_catalog(spark, sf))


# ===================================================================== sea
def _sea(spark: SparkSession, sf: str, minimum: float | None = None) -> DataFrame:
    return SEA.with_sea_percent(X.catalog(spark, sf), X.land(spark, sf), minimum)


@register("sea_percent", sql(["sea"], "SELECT Id, round(sea_percent, 6) AS sea_percent FROM sea"))
def sea_percent(spark: SparkSession, sf: str) -> DataFrame:
    return _sea(spark, sf).select("Id", _r6("sea_percent").alias("sea_percent"))


@register("sea_filter", sql(["sea"], "SELECT Id, Name FROM sea WHERE sea_percent >= 30"))
def sea_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _sea(spark, sf, 30).select("Id", "Name")


_HIST = {
    "lim": "SELECT min(sea_percent) AS lo, max(sea_percent) AS hi FROM sea",
    "hist": """SELECT b.bin, lo + b.bin * ((hi - lo) / 20) AS bin_low, lo + (b.bin + 1) * ((hi - lo) / 20) AS bin_high, coalesce(h.n, 0) AS n
       FROM (SELECT CAST(unnest(range(0, 20)) AS INTEGER) AS bin) b CROSS JOIN lim LEFT JOIN
       (SELECT CAST(least(floor((sea_percent - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM sea CROSS JOIN lim GROUP BY 1) h
       ON h.bin = b.bin""",
}


@register("sea_hist", sql(["sea"], "SELECT bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n FROM hist", _HIST))
def sea_hist(spark: SparkSession, sf: str) -> DataFrame:
    return I.sea_histogram(_sea(spark, sf)).select("bin", _r6("bin_low").alias("bin_low"), _r6("bin_high").alias("bin_high"), "n")


@register(
    "sea_cum_hist",
    sql(["sea"], "SELECT bin, round(bin_low, 6) AS bin_low, CAST(sum(n) OVER (ORDER BY bin DESC) AS BIGINT) AS n_at_least FROM hist", _HIST),
)
def sea_cum_hist(spark: SparkSession, sf: str) -> DataFrame:
    return I.sea_cumulative_histogram(_sea(spark, sf)).select("bin", _r6("bin_low").alias("bin_low"), "n_at_least")


@register(
    "sea_volume",
    sql(
        ["sea"],
        f"""SELECT p.pl AS polarisation, CAST(t.t AS INTEGER) AS min_sea_percent,
            round(coalesce(sum(CASE WHEN c.Id IS NOT NULL THEN {_VOLUME} END), 0.0), 6) AS volume
            FROM (SELECT unnest(['1SDV', '1SSV', '1SSH', '1SDH']) AS pl) p CROSS JOIN (SELECT unnest(range(0, 100, 10)) AS t) t
            LEFT JOIN sea c ON contains(c.Name, p.pl) AND c.sea_percent >= t.t GROUP BY ALL""",
    ),
)
def sea_volume(spark: SparkSession, sf: str) -> DataFrame:
    return I.volume_by_sea_threshold(_sea(spark, sf)).withColumn("volume", _r6("volume"))


_ON_LAND, _LAST = clipped("shape_land", LAND_SIDES, "cut")
_GENERAL = {
    **SHAPES,
    "shape_land": """SELECT s.*, lx0, ly0, lx1, ly1 FROM shape s JOIN land
      ON x0 < lx1 AND lx0 < x1 + 2 AND y0 < ly1 AND ly0 < y1 + 1""",
    **_ON_LAND,
    "own": f"SELECT Id, sum(sign * {AREA}) AS area FROM shape GROUP BY Id",
    "wet": f"SELECT Id, sum(sign * {AREA}) AS land_area FROM {_LAST} GROUP BY Id",
}


@register(
    "sea_percent_general",
    sql(["skew", "land"], "SELECT Id, round((area - coalesce(land_area, 0)) / area * 100, 6) AS sea_percent FROM own LEFT JOIN wet USING (Id)", _GENERAL),
)
def sea_percent_general(spark: SparkSession, sf: str) -> DataFrame:
    """Slanted and two-part footprints."""
    df = SEA.with_sea_percent(X.skewed_catalog(spark, sf), X.land(spark, sf))
    return df.select("Id", _r6("sea_percent").alias("sea_percent"))


_COMMON = "greatest(0, least(c.x1, {1}) - greatest(c.x0, {0})) * greatest(0, least(c.y1, {3}) - greatest(c.y0, {2}))"
_ONE = _COMMON.format("lx0", "lx1", "ly0", "ly1")
_TWO = _COMMON.format("lx0 + 18", "lx1 + 18", "ly0 + 9", "ly1 + 9")
_SHARED = _COMMON.format("greatest(a.lx0, b.lx0 + 18)", "least(a.lx1, b.lx1 + 18)", "greatest(a.ly0, b.ly0 + 9)", "least(a.ly1, b.ly1 + 9)")


@register(
    "sea_overlapping_land",
    sql(
        ["cat", "land"],
        """SELECT c.Id, round(((x1 - x0) * (y1 - y0) - one - two + shared) / ((x1 - x0) * (y1 - y0)) * 100, 6) AS sea_percent
           FROM cat c JOIN l USING (Id) JOIN s USING (Id)""",
        {
            "l": f"SELECT Id, sum({_ONE}) AS one, sum({_TWO}) AS two FROM cat c, land GROUP BY Id",
            "s": f"SELECT Id, CAST(sum({_SHARED}) AS DOUBLE) AS shared FROM cat c, (SELECT * FROM land) a, (SELECT * FROM land) b "
            "WHERE b.lx0 + 18 < a.lx1 AND a.lx0 < b.lx1 + 18 AND b.ly0 + 9 < a.ly1 AND a.ly0 < b.ly1 + 9 GROUP BY Id",
        },
    ),
)
def sea_overlapping_land(spark: SparkSession, sf: str) -> DataFrame:
    """Land polygons that repeat and overlap count once."""
    df = SEA.with_sea_percent(X.catalog(spark, sf), X.overlapping_land(spark, sf))
    return df.select("Id", _r6("sea_percent").alias("sea_percent"))


# at the share u of the way along its x range, crossing land covers y from 18 min(u, 1 - u) to 18 max(u, 1 - u)
_SPAN = "greatest(0, least(y1, ly0 + 18 * greatest((v - lx0) / 36, (lx1 - v) / 36)) - greatest(y0, ly0 + 18 * least((v - lx0) / 36, (lx1 - v) / 36)))"


@register(
    "sea_crossing_land",
    sql(
        ["cat", "land"],
        """SELECT Id, round(((x1 - x0) * (y1 - y0) - coalesce(land_area, 0)) / ((x1 - x0) * (y1 - y0)) * 100, 6) AS sea_percent
           FROM cat LEFT JOIN w USING (Id)""",
        {
            "met": """SELECT Id, CAST(y0 AS DOUBLE) AS y0, CAST(y1 AS DOUBLE) AS y1, lx0, lx1, ly0,
              CAST(greatest(x0, lx0) AS DOUBLE) AS a, CAST(least(x1, lx1) AS DOUBLE) AS b
              FROM cat JOIN land ON x0 < lx1 AND lx0 < x1 AND y0 < ly1 AND ly0 < y1""",
            "cuts": """SELECT *, list_sort(list_distinct(list_filter([a, b, lx0 + 18, lx0 + 2 * (y0 - ly0), lx1 - 2 * (y0 - ly0),
              lx0 + 2 * (y1 - ly0), lx1 - 2 * (y1 - ly0)]::DOUBLE[], lambda v: v >= a AND v <= b))) AS xs FROM met""",
            "spans": f"SELECT Id, xs, list_transform(xs, lambda v: {_SPAN}) AS f FROM cuts",
            "w": """SELECT Id, sum(list_sum(list_transform(range(1, len(xs)), lambda i: (xs[i + 1] - xs[i]) * (f[i] + f[i + 1]) / 2))) AS land_area
              FROM spans GROUP BY Id""",
        },
    ),
)
def sea_crossing_land(spark: SparkSession, sf: str) -> DataFrame:
    """Land rings that cross themselves cover their even-odd interior, half of their box."""
    df = SEA.with_sea_percent(X.catalog(spark, sf), X.crossing_land(spark, sf))
    return df.select("Id", _r6("sea_percent").alias("sea_percent"))


_CORNER = "({bx} - {ax}) * ({y} - {ay}) - ({by} - {ay}) * ({x} - {ax})"


def _apart(dx: float) -> str:
    """A slanted footprint part and the box (ax, ay, bx, by_) share a point: no side of either has the other beyond it."""
    ring = [(f"(x0 + {dx})", "(y0 + 0.5)"), (f"(x1 + {dx})", "y0"), (f"(x1 + {dx} + 0.5)", "y1"), (f"(x0 + {dx} + 0.25)", "(y1 + 0.5)")]
    sides = [
        "greatest(" + ", ".join(_CORNER.format(ax=p[0], ay=p[1], bx=q[0], by=q[1], x=x, y=y) for x in ("r.ax", "r.bx") for y in ("r.ay", "r.by_")) + ") >= 0"
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True)
    ]
    box = f"x0 + {dx} <= r.bx AND r.ax <= x1 + {dx} + 0.5 AND y0 <= r.by_ AND r.ay <= y1 + 0.5"
    return "(" + " AND ".join([box, *sides]) + ")"


@register(
    "search_polygon_general",
    sql(
        ["req", "cat"],
        f"""SELECT r.request_key, c.Id FROM req r JOIN cat c ON (r.s IS NULL OR c.content_start > r.s) AND (r.e IS NULL OR c.content_start < r.e)
          AND (r.collection IS NULL OR c.collection = r.collection) AND (r.name_part IS NULL OR contains(c.Name, r.name_part))
          AND (r.sensormode IS NULL OR c.mode = r.sensormode) AND (r.producttype IS NULL OR c.ptype = r.producttype)
          AND (r.cloud_max IS NULL OR c.cloud <= r.cloud_max)
          AND ({_apart(0.0)} OR (ends_with(c.Id, '-v2') AND {_apart(1.0)}))
          WHERE r.area_kind IS NOT NULL""",
    ),
)
def search_polygon_general(spark: SparkSession, sf: str) -> DataFrame:
    """Area requests over slanted and two-part footprints."""
    req = R.normalize_requests(X.requests(spark, sf)).filter("area_kind <> 'none'")
    return S.search(req, X.skewed_catalog(spark, sf)).select("request_key", "Id")


_RECT = "x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1"
_MID = "replace(CAST((x0 + x1) / 2.0 AS VARCHAR), '.0', '') || ' ' || (y0 + 1)"
_BOW = (
    f"'MULTIPOLYGON (((' || x0 || ' ' || y0 || ', ' || {_MID} || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || ')), ((' || {_MID} "
    f"|| ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 || ', ' || {_MID} || ')))'"
)


@register(
    "geometry_repair",
    sql(
        ["cat"],
        f"""SELECT Id, true AS repaired, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) / CASE WHEN split_part(Id, '-', 2) = '1' THEN 2 ELSE 1 END AS area,
          CASE WHEN split_part(Id, '-', 2) = '1' THEN {_BOW} ELSE 'POLYGON ((' || {_RECT} || '))' END AS wkt FROM cat""",
    ),
)
def geometry_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Footprints mended: rings left open that run clockwise, and (products numbered 1) rings that cross themselves."""
    c = X.catalog(spark, sf).withColumn("box", G.bbox(G.geometry_from_wkt(G.footprint_wkt("Footprint"))))
    ring = lambda *corners: F.array(*[F.struct(F.col("box")[x].alias("x"), F.col("box")[y].alias("y")) for x, y in corners])
    still_open = ring(("x0", "y1"), ("x1", "y1"), ("x1", "y0"), ("x0", "y0"))
    crossing = ring(("x0", "y0"), ("x1", "y1"), ("x1", "y0"), ("x0", "y1"), ("x0", "y0"))
    points = F.when(F.split_part("Id", F.lit("-"), F.lit(2)) == "1", crossing).otherwise(still_open)
    broken = F.struct(F.lit("POLYGON").alias("kind"), F.array(F.struct(F.lit(False).alias("hole"), points.alias("pts"))).alias("rings"))
    c = with_simple_geometry(c.select("Id", "box"), "geom", broken)
    return c.select("Id", F.col("geom_mended").alias("repaired"), _r6(G.area("geom")).alias("area"), G.geometry_to_wkt("geom").alias("wkt"))


@register(
    "footprint_union",
    sql(
        ["skew"],
        """SELECT Id, 'POLYGON' AS kind, two AS repaired, CAST(1 AS INTEGER) AS n_rings, CAST(CASE WHEN two THEN 9 ELSE 5 END AS INTEGER) AS n_points,
           round(area, 6) AS area, CAST(x1 + 0.5 + CASE WHEN two THEN 1 ELSE 0 END AS DOUBLE) AS east FROM skew JOIN own USING (Id)""",
        {**SHAPES, "own": _GENERAL["own"]},
    ),
)
def footprint_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two-part footprints become the outline of their union, as the product table writes them."""
    df = S.with_simple_footprints(X.skewed_catalog(spark, sf))
    rings = F.col("geom")["rings"]
    return df.select(
        "Id", F.col("geom")["kind"].alias("kind"), "repaired", F.size(rings).alias("n_rings"),
        F.size(F.flatten(F.transform(rings, lambda r: r["pts"]))).alias("n_points"), _r6(G.area("geom")).alias("area"), F.col("box")["x1"].alias("east"),
    )


# ===================================================================== transfers
@register(
    "transfer_summary",
    sql(
        ["xfer"],
        """SELECT count(*) AS successful_download, round(avg(speed), 6) AS mean_speed, round(stddev_pop(speed), 6) AS std_speed,
           round(avg(elapsed_time), 6) AS mean_elapsed, round(stddev_pop(elapsed_time), 6) AS std_elapsed,
           round(sum(total_mb) / 1024, 6) AS total_gb, round(avg(total_mb) / 1024, 6) AS mean_gb FROM xfer WHERE status_meaning = 'Downloaded'""",
    ),
)
def transfer_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = T.transfer_summary(X.transfer_log(spark, sf))
    return df.select("successful_download", *[_r6(c).alias(c) for c in df.columns if c != "successful_download"])


@register(
    "transfer_status",
    sql(
        ["xfer"],
        """SELECT status_meaning, count(*) AS n, status_meaning NOT IN ('OK', 'Downloaded') AS failed FROM xfer
           WHERE status_meaning IS NOT NULL GROUP BY status_meaning""",
    ),
)
def transfer_status(spark: SparkSession, sf: str) -> DataFrame:
    return T.transfer_status(X.transfer_log(spark, sf))


@register(
    "transfer_errors",
    sql(
        ["xfer"],
        """SELECT batch, login, count(*) AS n_errors, count(*) >= 4 AS blacklisted FROM xfer
           WHERE status_meaning NOT IN ('OK', 'Downloaded') GROUP BY batch, login""",
    ),
)
def transfer_errors(spark: SparkSession, sf: str) -> DataFrame:
    return T.errors_per_login(X.transfer_log(spark, sf))


@register(
    "transfer_eta",
    sql(
        ["xfer"],
        """SELECT round(a, 6) AS avg_speed, round(mn, 6) AS min_speed, round(mx, 6) AS max_speed, remaining, parallel, eta_seconds,
           CASE WHEN eta_seconds IS NULL THEN NULL WHEN eta_seconds >= 3600 THEN (eta_seconds // 3600) || 'h' || printf('%02d', eta_seconds % 3600 // 60) || 'm'
             ELSE (eta_seconds // 60) || 'm' || printf('%02d', eta_seconds % 60) || 's' END AS eta
           FROM (SELECT *, CAST(floor(tm * remaining / parallel) AS BIGINT) AS eta_seconds FROM (
             SELECT avg(speed) FILTER (status_meaning = 'Downloaded') AS a, min(speed) FILTER (status_meaning = 'Downloaded') AS mn,
               max(speed) FILTER (status_meaning = 'Downloaded') AS mx, avg(elapsed_time) FILTER (status_meaning = 'Downloaded') AS tm,
               count(*) FILTER (status IN (0, 2)) AS remaining, greatest(count(*) FILTER (status = 2), 1) AS parallel FROM xfer))""",
    ),
)
def transfer_eta(spark: SparkSession, sf: str) -> DataFrame:
    df = T.transfer_eta(X.transfer_log(spark, sf))
    speeds = ["avg_speed", "min_speed", "max_speed"]
    return df.select(*[(_r6(c).alias(c) if c in speeds else F.col(c)) for c in df.columns])


@register(
    "object_manifest",
    sql(
        ["listing", "obj"],
        """SELECT l.line_no, l.safename, coalesce(o.n, 0) AS n_objects, coalesce(o.b, 0) AS total_bytes, coalesce(o.b, 0) / 1e6 AS total_mb,
           CASE WHEN o.n IS NULL THEN 'NotFound' WHEN o.n = 1 THEN 'single' ELSE 'multi' END AS layout
           FROM listing l LEFT JOIN (SELECT Name, count(*) AS n, CAST(sum(size) AS BIGINT) AS b FROM obj GROUP BY Name) o ON o.Name = l.safename""",
    ),
)
def object_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return T.object_manifest(X.listing(spark, sf), X.objects(spark, sf))


@register(
    "object_local_paths",
    sql(
        ["obj"],
        "SELECT key, Name AS safename, part AS relative_path, '/home/out/' || Name || '/' || part AS local_path, size FROM obj WHERE part <> ''",
    ),
)
def object_local_paths(spark: SparkSession, sf: str) -> DataFrame:
    return T.object_local_paths(X.objects(spark, sf), X.OUTDIR)
