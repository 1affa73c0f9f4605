"""Request tables: normalising, checking, slicing in time, rendering as filter text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import geometry as G
from swathbook.functions import names as N
from swathbook.functions.polygons import valid
from swathbook.operators.skew import skew_join

_ALIASES = {"startdate": "start_datetime", "stopdate": "end_datetime", "geofeature": "geometry"}
_OPTIONAL = {
    "start_datetime": "timestamp",
    "end_datetime": "timestamp",
    "geometry": "string",
    "collection": "string",
    "name": "string",
    "sensormode": "string",
    "producttype": "string",
    "Attributes": "string",
}


def rename_aliases(requests: DataFrame) -> DataFrame:
    """Accept the alternative column names."""
    for old, new in _ALIASES.items():
        if old in requests.columns:
            requests = requests.withColumnRenamed(old, new)
    return requests


def normalize_requests(requests: DataFrame, key: str = "request_key") -> DataFrame:
    """Fill in what a request may leave out.

    Adds missing optional columns as null, ``id_original_query`` (``id_query`` or
    else the row key), times as UTC timestamps, and the area: ``area`` (parsed
    geometry), ``area_kind`` in point / polygon / none and ``is_world``. A missing
    or unreadable area is the whole world. Areas of other kinds filter nothing.
    """
    df = rename_aliases(requests)
    if key not in df.columns:
        raise KeyError(f"requests need a unique key column {key!r}")
    for column, kind in _OPTIONAL.items():
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast(kind))
    if "id_query" not in df.columns:
        df = df.withColumn("id_query", F.lit(None).cast("string"))
    parsed = G.geometry_from_wkt("geometry")
    # the whole world filters nothing, also where it is written out
    parsed = F.when(F.translate("geometry", " ", "") == F.translate(F.lit(K.WORLD_WKT), " ", ""), F.lit(None)).otherwise(parsed)
    return (
        df.withColumn("request_key", F.col(key).cast("string"))
        .withColumn("id_original_query", F.coalesce(F.col("id_query").cast("string"), F.col("request_key")))
        .withColumn("start_datetime", F.col("start_datetime").cast("timestamp"))
        .withColumn("end_datetime", F.col("end_datetime").cast("timestamp"))
        .withColumn("area", parsed)
        .withColumn("is_world", F.col("area").isNull())
        .withColumn("geometry", F.when(F.col("area").isNull(), K.WORLD_WKT).otherwise(F.col("geometry")))
        .withColumn(
            "area_kind",
            F.when(F.col("area")["kind"] == "POINT", "point")
            .when(F.col("area")["kind"].isin("POLYGON", "MULTIPOLYGON"), "polygon")
            .otherwise("none"),
        )
        .withColumn("attr_name", attribute_filter("Attributes")["name"])
        .withColumn("attr_max", attribute_filter("Attributes")["max"])
    )


def attribute_filter(text: str | Column) -> Column:
    """``"name,value"`` (spaces ignored) as ``STRUCT<name, max>``."""
    part = F.split(F.replace(N._col(text), F.lit(" "), F.lit("")), ",")
    return F.struct(F.get(part, 0).alias("name"), F.get(part, 1).try_cast("double").alias("max"))


def duplicate_keys(requests: DataFrame, key: str = "request_key") -> DataFrame:
    """Row keys that occur more than once."""
    return (
        requests.groupBy(F.col(key).cast("string").alias("request_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def invalid_areas(normalized: DataFrame) -> DataFrame:
    """Requests whose polygon is open, degenerate or crosses itself."""
    return normalized.filter(~F.coalesce(valid(F.col("area")), F.lit(True))).select(
        "request_key", "id_original_query", "geometry"
    )


def check_requests(requests: DataFrame, key: str = "request_key") -> DataFrame:
    """Normalise, and fail like a strict client: repeated keys or invalid polygons raise.

    Only a handful of offenders reaches the driver, for the message.
    """
    repeated = duplicate_keys(rename_aliases(requests), key).limit(20).collect()
    if repeated:
        raise IndexError(f"request keys must be unique, repeated: {sorted(r[0] for r in repeated)}")
    normalized = normalize_requests(requests, key)
    wrong = invalid_areas(normalized).limit(20).collect()
    if wrong:
        raise ValueError(f"invalid areas in requests: {sorted(r[0] for r in wrong)}")
    return normalized


# --------------------------------------------------------------------- time slices
def slice_requests(
    requests: DataFrame,
    width: dt.timedelta = dt.timedelta(days=K.DEFAULT_SLICE_DAYS),
    mode: str = "exact",
    now: dt.datetime | None = None,
) -> DataFrame:
    """Split request windows along a grid shared by all requests of one ``id_original_query``.

    The grid starts at the group's earliest start and ends at its latest end (one
    day after ``now`` when that lies in the future). Each row computes its own slice
    numbers from the group's two bounds, so a group is never gathered.

    ``mode="reference"``: windows not longer than ``width`` stay whole and only in a
    slice that contains them, others are clipped to every slice they touch; rows
    with an open bound drop out of a group that has a grid. ``mode="exact"``: every
    window is clipped, nothing is lost, and ``start_inclusive`` marks inner
    boundaries as half-open; rows with an open bound stay whole.
    """
    if mode not in ("exact", "reference"):
        raise ValueError(mode)
    us = int(width / dt.timedelta(microseconds=1))
    bounds = (
        requests.groupBy("id_original_query")
        .agg(F.min("start_datetime").alias("_lo"), F.max("end_datetime").alias("_hi"))
        .withColumn("_lo", F.unix_micros("_lo"))
        .withColumn("_hi", F.unix_micros("_hi"))
    )
    clock = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    limit = F.unix_micros(clock)
    bounds = bounds.withColumn(
        "_hi", F.when(F.col("_hi") > limit, limit + 86_400_000_000).otherwise(F.col("_hi"))
    ).withColumn("_n", F.ceil((F.col("_hi") - F.col("_lo")) / us))
    df = skew_join(requests, bounds, ["id_original_query"], "left", row_id=["request_key"])
    df = df.withColumn("_s", F.unix_micros("start_datetime")).withColumn("_e", F.unix_micros("end_datetime"))
    has_grid = F.coalesce(F.col("_n") > 0, F.lit(False))
    lo, last = F.col("_lo"), (F.col("_n") - 1)
    s, e = F.col("_s") - lo, F.col("_e") - lo
    long_row = (F.col("_e") - F.col("_s")) > us
    none = F.array().cast("array<bigint>")

    def upto(first: Column, final: Column) -> Column:
        first, final = first.cast("bigint"), final.cast("bigint")
        return F.when(first <= final, F.sequence(first, final)).otherwise(none)

    # slice i covers [i*us, (i+1)*us]; touching counts
    touched_from = F.greatest(F.ceil(s / us) - 1, F.lit(0))
    touched_to = F.least(F.floor(e / us), last)
    if mode == "reference":
        inside = F.filter(
            upto(touched_from, touched_to), lambda i: (s >= i * us) & (e <= (i + 1) * us)
        )
        wanted = F.when(long_row, upto(touched_from, touched_to)).otherwise(inside)
        wanted = F.when(F.col("_s").isNull() | F.col("_e").isNull(), none).otherwise(wanted)
    else:
        final = F.greatest(F.least(F.ceil(e / us) - 1, last), F.floor(s / us))
        wanted = upto(F.floor(s / us), final)
        wanted = F.when(F.col("_s").isNull() | F.col("_e").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(
            F.when(F.col("_e") < F.col("_s"), F.array(F.lit(0).cast("bigint"))).otherwise(wanted)
        )
    df = df.withColumn("slice_no", F.explode(F.when(has_grid, wanted).otherwise(F.array(F.lit(0).cast("bigint")))))
    begin, end = lo + F.col("slice_no") * us, lo + (F.col("slice_no") + 1) * us
    new_s, new_e = F.greatest(F.col("_s"), begin), F.least(F.col("_e"), end)
    if mode == "reference":
        clip = has_grid & long_row
        inclusive = F.lit(False)
    else:
        # the last slice of a row keeps the row's own end, also beyond the capped grid
        clip = has_grid & F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("_s") <= F.col("_e"))
        final = F.greatest(F.least(F.ceil(e / us) - 1, last), F.floor(s / us))
        new_e = F.when(F.col("slice_no") == final, F.col("_e")).otherwise(new_e)
        inclusive = clip & (begin > F.col("_s"))
    out = df.withColumn(
        "start_datetime", F.when(clip, F.timestamp_micros(new_s)).otherwise(F.col("start_datetime"))
    ).withColumn("end_datetime", F.when(clip, F.timestamp_micros(new_e)).otherwise(F.col("end_datetime")))
    return out.withColumn("start_inclusive", F.coalesce(inclusive, F.lit(False))).drop("_lo", "_hi", "_n", "_s", "_e")


# --------------------------------------------------------------------- filter text
def filter_text() -> Column:
    """Filter clauses of a normalised request, joined by ' and '; null fields give no clause."""
    wkt = F.col("geometry")
    first_close = F.instr(wkt, ")")
    first_open = F.instr(wkt, "(")
    inner = F.substring(wkt, first_open + 1, first_close - first_open - 1)
    kind = F.when(F.col("area").isNull(), "POLYGON").otherwise(F.col("area")["kind"])
    time = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.'000Z'")
    # Clause texts of the public catalog protocol.
    area = F.when(
        kind == "POINT",
        F.concat(
            F.lit("OData.CSC.Intersects(area=geography'SRID=4326;POINT("),
            F.replace(inner, F.lit(" "), F.lit("%20")),
            F.lit(")')"),
        ),
    ).when(
        kind == "POLYGON",
        F.concat(F.lit("OData.CSC.Intersects(area=geography'SRID=4326;POLYGON("), inner, F.lit("))')")),
    )
    string_attribute = (
        "Attributes/OData.CSC.StringAttribute/any(att:att/Name eq '%s' and "
        "att/OData.CSC.StringAttribute/Value eq '"
    )
    clauses = [
        area,
        F.concat(F.lit("Collection/Name eq '"), F.col("collection"), F.lit("'")),
        F.concat(F.lit("contains(Name,'"), F.col("name"), F.lit("')")),
        F.concat(F.lit(string_attribute % "operationalMode"), F.col("sensormode"), F.lit("')")),
        F.concat(F.lit(string_attribute % "productType"), F.col("producttype"), F.lit("')")),
        F.concat(F.lit("ContentDate/Start gt "), time("start_datetime")),
        F.concat(F.lit("ContentDate/Start lt "), time("end_datetime")),
        F.concat(
            F.lit("Attributes/OData.CSC.DoubleAttribute/any(att:att/Name eq '"),
            F.col("attr_name"),
            F.lit("' and att/OData.CSC.DoubleAttribute/Value le "),
            F.get(F.split(F.replace(F.col("Attributes"), F.lit(" "), F.lit("")), ","), 1),
            F.lit(")"),
        ),
    ]
    return F.concat_ws(" and ", *clauses)


def render_requests(normalized: DataFrame, top: int = K.DEFAULT_TOP, url: str = K.SEARCH_URL) -> DataFrame:
    """Add ``filter_text``, the full ``request_url`` and its md5 ``fingerprint``."""
    return (
        normalized.withColumn("filter_text", filter_text())
        .withColumn("request_url", F.concat(F.lit(url), F.col("filter_text"), F.lit(f"&$top={top}&$expand=Attributes")))
        .withColumn("fingerprint", F.md5("request_url"))
    )


# --------------------------------------------------------------------- requests from names
def requests_from_names(
    listing: DataFrame,
    name: str = "safename",
    private_units: list[str] | None = None,
    mode: str = "default",
    line: str = "line_no",
) -> DataFrame:
    """One request per listed radar product, wide enough to find it again.

    ``request_key`` is the listing's line; a listing without the column ``line`` gives one request per distinct name.

    The window runs from one second before the start to one second after the end of
    the name (``mode="reference"``: one second before the end). Names that cannot be
    read give no request.
    """
    fields = N.s1_fields(name)
    shift = F.expr("INTERVAL 1 SECOND")
    end = fields["enddate"] - shift if mode == "reference" else fields["enddate"] + shift
    if line not in listing.columns:
        listing = listing.select(name).distinct()
    return (
        listing.filter(F.col(name).rlike(".SAFE"))
        .filter(N.s1_start(name).isNotNull())
        .select(
            F.col(line if line in listing.columns else name).cast("string").alias("request_key"),
            F.lit("batch_query").alias("id_query"),
            (fields["startdate"] - shift).alias("start_datetime"),
            end.alias("end_datetime"),
            F.lit(K.WORLD_WKT).alias("geometry"),
            F.lit("SENTINEL-1").alias("collection"),
            F.col(name).alias("name"),
            fields["mode"].alias("sensormode"),
            N.product_type(name, private_units).alias("producttype"),
            F.lit(None).cast("string").alias("Attributes"),
        )
    )
