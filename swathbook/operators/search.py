"""Catalog search: the interval / area join of requests with products, and what follows it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import geometry as G
from swathbook.functions import names as N
from swathbook.functions.polygons import with_simple_geometry
from swathbook.operators.once import computed_once
from swathbook.operators.requests import normalize_requests
from swathbook.operators.skew import BROADCAST_ROWS, PAIRS_PER_SLOT, ROWS_PER_SLOT, grid_join

DAY = 86_400
BLOCK_DAYS = 32
CELL_DEGREES = 20.0

# levels of the time key: single days and blocks of days
_DAYS, _BLOCKS = 0, 1
#: A whole product name; a request for one is joined by equality.
WHOLE_NAME = r"S[1-6][A-Z]_.*?\.(?:SAFE|SEN3)"
#: Characters of the pieces by which shorter parts of a name are looked up.
GRAM = 5
#: Pairs of requests and products that one task gets where products are dealt by name, and tasks at most.
PAIRS_PER_TASK, MOST_TASKS = 1_000_000, 10_000


@dataclass(frozen=True)
class RequestProfile:
    """What one pass over the request table tells about it."""

    keys: int
    day_keys: int
    has_blocks: bool
    has_open: bool
    has_area: bool
    has_no_area: bool
    first_start: int | None  # microseconds since 1970, as last_end
    last_end: int | None
    first_month: str | None
    last_month: str | None
    collection: str | None
    named: int  # requests by a whole name, and by a part of a name with an open window
    in_part: int
    others: int


# --------------------------------------------------------------------- preparing both sides
def _second(c: str) -> Column:
    return F.date_trunc("second", F.col(c))


def _time_keys(blocks: bool) -> Column:
    """Time keys of a request: single days, with whole blocks of days where ``blocks`` allows.

    An open side reaches to the catalog's first or last start.
    """
    first = F.floor(F.unix_seconds("_key_from") / DAY).cast("int")
    last = F.floor(F.unix_seconds("_key_to") / DAY).cast("int")
    block_from = F.ceil(first / BLOCK_DAYS).cast("int")
    block_to = F.floor((last + 1) / BLOCK_DAYS).cast("int") - 1
    none = F.array().cast("array<struct<level:int,bucket:int>>")

    def keys(level: int, lo: Column, hi: Column) -> Column:
        return F.when(
            lo <= hi,
            F.transform(
                F.sequence(lo, hi), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bucket"))
            ),
        ).otherwise(none)

    with_blocks = F.concat(
        keys(_DAYS, first, block_from * BLOCK_DAYS - 1),
        keys(_BLOCKS, block_from, block_to),
        keys(_DAYS, (block_to + 1) * BLOCK_DAYS, last),
    )
    windowed = keys(_DAYS, first, last)
    if blocks:
        windowed = F.when(block_from <= block_to, with_blocks).otherwise(windowed)
    return windowed


_NO_CELL = -999


def _no_cell() -> Column:
    return F.struct(F.lit(_NO_CELL).alias("cx"), F.lit(_NO_CELL).alias("cy"))


def whole_name(text: str | Column) -> Column:
    """The first whole product name in a text, or null."""
    return F.nullif(F.regexp_extract(N._col(text), f"({WHOLE_NAME})", 1), F.lit(""))


def _by_part() -> Column:
    """The request gives a part of a name that is long enough to look up, and no window that would cut the days."""
    no_window = F.col("_from").isNull() & F.col("_to").isNull()
    return F.coalesce(F.col("_whole").isNull() & (F.length("_name") >= GRAM) & no_window, F.lit(False))


def prepare_requests(
    requests: DataFrame,
    mode: str = "default",
    cell_degrees: float = CELL_DEGREES,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """Normalised requests with the key arrays of the join.

    ``span``: first and last start of the catalog in seconds since 1970, where open windows end; without it they have
    no time keys.
    """
    df = requests if "id_original_query" in requests.columns else normalize_requests(requests)
    if "slice_no" not in df.columns:
        df = df.withColumn("slice_no", F.lit(0).cast("bigint"))
    if "start_inclusive" not in df.columns:
        df = df.withColumn("start_inclusive", F.lit(False))
    spatial = F.col("area_kind") != "none"
    if mode == "reference":
        spatial = spatial & (F.col("area")["kind"] != "MULTIPOLYGON")
    df = df.select(
        "request_key",
        "id_original_query",
        "slice_no",
        F.col("collection").alias("_collection"),
        F.col("name").alias("_name"),
        F.when(whole_name("name") == F.col("name"), F.col("name")).alias("_whole"),
        F.col("sensormode").alias("_mode"),
        F.col("producttype").alias("_type"),
        F.col("attr_name").alias("_attr"),
        F.col("attr_max").alias("_attr_max"),
        _second("start_datetime").alias("_from"),
        _second("end_datetime").alias("_to"),
        F.col("start_inclusive").alias("_from_closed"),
        F.when(spatial, G.exterior_only("area")).alias("_area"),
    )
    df = computed_once(df, {c: F.col(c) for c in ("_from", "_to", "_area")})
    none = F.lit(None).cast("timestamp")
    first, last = [none if t is None else F.timestamp_seconds(F.lit(t)) for t in span or (None, None)]
    df = df.withColumn("_key_from", F.coalesce("_from", first)).withColumn("_key_to", F.coalesce("_to", last))
    df = computed_once(df, {"_area_box": G.bbox("_area"), "_area_is_box": G.is_box("_area"), "_times": _time_keys(True)})
    return df.withColumn("_cells", F.coalesce(G.cells(F.col("_area_box"), cell_degrees), F.array(_no_cell())))


def profile_requests(prepared: DataFrame) -> RequestProfile:
    """One aggregated row: decides the join strategy and the literal scan filters."""
    is_open = F.col("_from").isNull() | F.col("_to").isNull()
    days = F.coalesce(F.greatest(F.datediff("_key_to", "_key_from") + 1, F.lit(0)), F.lit(0))
    first_start = F.when(F.count_if(F.col("_from").isNull()) == 0, F.min("_from"))
    last_end = F.when(F.count_if(F.col("_to").isNull()) == 0, F.max("_to"))
    row = prepared.agg(
        F.coalesce(F.sum((F.size("_times") * F.size("_cells")).cast("bigint")), F.lit(0)).alias("keys"),
        F.coalesce(F.sum(days * F.size("_cells")), F.lit(0)).cast("bigint").alias("day_keys"),
        F.coalesce(F.max(F.exists("_times", lambda t: t["level"] == _BLOCKS)), F.lit(False)).alias("blocks"),
        F.coalesce(F.max(is_open), F.lit(False)).alias("open"),
        F.coalesce(F.max(F.col("_area").isNotNull()), F.lit(False)).alias("area"),
        F.coalesce(F.max(F.col("_area").isNull()), F.lit(False)).alias("no_area"),
        F.unix_micros(first_start).alias("first_start"),
        F.unix_micros(last_end).alias("last_end"),
        F.date_format(first_start, "yyyy-MM").alias("first_month"),
        F.date_format(last_end, "yyyy-MM").alias("last_month"),
        F.when(
            (F.count_if(F.col("_collection").isNull()) == 0) & (F.min("_collection") == F.max("_collection")),
            F.min("_collection"),
        ).alias("collection"),
        F.count_if(F.col("_whole").isNotNull()).alias("named"),
        F.count_if(_by_part()).alias("in_part"),
        F.count_if(F.col("_whole").isNull() & ~_by_part()).alias("others"),
    ).first()
    return RequestProfile(
        row["keys"],
        row["day_keys"],
        row["blocks"],
        row["open"],
        row["area"],
        row["no_area"],
        row["first_start"],
        row["last_end"],
        row["first_month"],
        row["last_month"],
        row["collection"],
        row["named"],
        row["in_part"],
        row["others"],
    )


def with_geometry(catalog: DataFrame) -> DataFrame:
    """Add ``geom`` (parsed footprint) and ``box`` unless the table has them."""
    if "geom" in catalog.columns and "box" in catalog.columns:
        return catalog
    both = G.footprint_geometry("Footprint")
    return computed_once(catalog, {"_g": both}).select(
        *[c for c in catalog.columns if c != "geom"], F.col("_g")["geom"].alias("geom"), F.col("_g")["box"].alias("box")
    )


def with_simple_footprints(found: DataFrame) -> DataFrame:
    """Add ``geom`` (footprint without crossing rings, overlapping parts united), its ``box`` and ``repaired``.

    ``repaired`` tells that the geometry is not as it was given.
    """
    df = with_simple_geometry(found.drop("geom"), "geom", G.geometry_from_wkt(G.footprint_wkt("Footprint")))
    return df.withColumn("box", G.bbox("geom")).withColumnRenamed("geom_mended", "repaired")


def _attribute_values(catalog: DataFrame, name: str) -> Column:
    if name in catalog.columns:  # promoted column of the stored catalog
        return F.array(F.col(name))
    return F.transform(F.filter("Attributes", lambda a: a["Name"] == name), lambda a: a["Value"])


def _prune(catalog: DataFrame, p: RequestProfile) -> DataFrame:
    """Literal bounds common to all requests; they reach the scan and its partitions."""
    if p.collection is not None:
        catalog = catalog.filter(F.col("collection") == p.collection)
    if p.first_start is not None:
        catalog = catalog.filter(F.col("content_start") >= F.timestamp_micros(F.lit(p.first_start)))
        if "start_month" in catalog.columns:
            catalog = catalog.filter(F.col("start_month") >= p.first_month)
    if p.last_end is not None:
        catalog = catalog.filter(F.col("content_start") < F.timestamp_micros(F.lit(p.last_end)))
        if "start_month" in catalog.columns:
            catalog = catalog.filter(F.col("start_month") <= p.last_month)
    return catalog


def _prune_months(catalog: DataFrame, prepared: DataFrame, p: RequestProfile) -> DataFrame:
    """A stored catalog cut to the months that some request's window touches; Spark prunes its partitions by them at run time.

    The months of all windows, at most those from the first to the last, are broadcast.
    """
    if "start_month" not in catalog.columns or p.first_month is None or p.last_month is None:
        return catalog
    every = F.sequence(F.trunc("_from", "MM"), F.trunc("_to", "MM"), F.expr("INTERVAL '1' MONTH"))
    months = prepared.filter(F.col("_from") <= F.col("_to")).select(F.explode(F.transform(every, lambda m: F.date_format(m, "yyyy-MM"))).alias("start_month")).distinct()
    months = months.filter(F.col("start_month").between(p.first_month, p.last_month))
    return catalog.join(F.broadcast(months), "start_month", "left_semi")


def catalog_span(catalog: DataFrame) -> tuple[int, int]:
    """First and last start of the products, in seconds; one aggregate over one column."""
    start = F.unix_seconds("content_start")
    row = catalog.agg(F.min(start).alias("first"), F.max(start).alias("last")).first()
    return (0, 0) if row["first"] is None else (row["first"], row["last"])


def _product_times(p: RequestProfile, span: tuple[int, int] | None) -> list[Column]:
    """Time keys of a product: its day, and the block of days if requests have blocks."""
    start = F.unix_seconds("content_start")
    if span is not None:
        start = F.coalesce(start, F.lit(span[0]))
    day = F.floor(start / DAY).cast("int")
    key = lambda level, bucket: F.struct(F.lit(level).alias("level"), bucket.alias("bucket"))
    times = [key(_DAYS, day)]
    if p.has_blocks:
        times.append(key(_BLOCKS, F.floor(day / BLOCK_DAYS).cast("int")))
    return times


def _pairs_by_time(prepared: DataFrame, catalog: DataFrame, p: RequestProfile, span: tuple[int, int] | None) -> tuple[int, int]:
    """Pairs of requests and products that share a time key, more than a search finds, and products. Areas are not looked at."""
    asked = prepared.select(F.explode("_times").alias("_time")).groupBy("_time").agg(F.count(F.lit(1)).alias("_asked"))
    held = _prune(catalog, p).select(F.explode(F.array(*_product_times(p, span))).alias("_time")).groupBy("_time").agg(F.count(F.lit(1)).alias("_held"))
    pairs = F.sum(F.col("_held").cast("double") * F.col("_asked")).alias("pairs")
    row = held.join(asked, "_time", "left").agg(pairs, F.sum(F.when(F.col("_time.level") == _DAYS, F.col("_held"))).alias("products")).first()
    return int(row["pairs"] or 0), row["products"] or 0


def _prepare_catalog(
    catalog: DataFrame, p: RequestProfile, cell_degrees: float, span: tuple[int, int] | None
) -> DataFrame:
    """Products repeated once per key a request might ask them by (usually one or two).

    A product without a start is only found by windows open on both sides; it lies on the catalog's first day.
    """
    times = _product_times(p, span)
    df = _prune(catalog, p).withColumn("_modes", _attribute_values(catalog, "operationalMode"))
    df = df.withColumn("_types", _attribute_values(catalog, "productType"))
    cells = F.array().cast("array<struct<cx:int,cy:int>>")
    if p.has_area:
        df = with_geometry(df)
        df = df.withColumn("_geom_is_box", G.is_box("geom"))
        cells = F.coalesce(G.cells(F.col("box"), cell_degrees), cells)
    if p.has_no_area:
        cells = F.concat(cells, F.array(_no_cell()))
    df = df.withColumn("_cell", F.explode_outer(cells))
    if len(times) == 1:
        return df.withColumn("_time", times[0])
    return df.withColumn("_time", F.explode_outer(F.array(*times)))


def _asked(p: RequestProfile, in_shared_cell: Column) -> Column:
    """Everything a request asks for, beyond the equi-keys; null request fields ask nothing."""

    def unless_null(field: str, test: Column) -> Column:
        return F.col(field).isNull() | test

    start = F.col("content_start")
    after = (start > F.col("_from")) | (F.col("_from_closed") & (start == F.col("_from")))
    cond = (
        unless_null("_from", after)
        & unless_null("_to", start < F.col("_to"))
        & unless_null("_collection", F.col("collection") == F.col("_collection"))
        & unless_null("_mode", F.array_contains("_modes", F.col("_mode")))
        & unless_null("_type", F.array_contains("_types", F.col("_type")))
        & unless_null("_name", F.col("Name").contains(F.col("_name")))
        & unless_null(
            "_attr",
            F.exists(
                "Attributes",
                lambda a: (a["Name"] == F.col("_attr")) & (a["Value"].try_cast("double") <= F.col("_attr_max")),
            ),
        )
    )
    if p.has_area:
        box, area_box = F.col("box"), F.col("_area_box")
        exact = (F.col("_geom_is_box") & (F.col("_area_is_box") | (F.col("_area")["kind"] == "POINT"))) | G.intersects(
            "geom", "_area"
        )
        cond = cond & unless_null(
            "_area",
            G.boxes_overlap(box, area_box) & in_shared_cell & exact,
        )
    return cond


def search(
    requests: DataFrame,
    catalog: DataFrame,
    top: int | None = None,
    mode: str = "default",
    strategy: str = "auto",
    cell_degrees: float = CELL_DEGREES,
    rows_per_slot: int = ROWS_PER_SLOT,
    broadcast_keys: int = BROADCAST_ROWS,
    pairs_per_slot: int = PAIRS_PER_SLOT,
    by_name: bool = False,
) -> DataFrame:
    """Products matching each request, tagged ``id_original_query``, ``request_key``, ``slice_no``.

    The request window is cut into day keys (blocks of 32 days where it is long),
    its area into grid cells; a product has its own day and the cells of its box. Open
    windows reach to the catalog's first or last start, which one aggregate finds. A
    pair meets under exactly one time key and is reported in exactly one cell, so
    the result needs no distinct. Requests for a whole product name are joined by that name alone; those for a part of a
    name without a window first find the names that hold it. One aggregate over the request table chooses the
    strategy: when the request keys number at most ``broadcast_keys`` they are
    broadcast and the catalog is not shuffled; otherwise both sides shuffle on
    (time, cell), and keys with many rows or many pairs are cut on both sides.

    ``top`` keeps the first rows of each (request, slice) by start and Id and sets
    ``capped``; by default nothing is cut. ``mode="reference"`` gives MULTIPOLYGON
    requests no area filter. ``by_name`` deals the catalog by Name before requests are broadcast, so that what follows
    by name shuffles no pairs.
    """
    prepared = prepare_requests(requests, mode, cell_degrees)
    profile = profile_requests(prepared)
    tags = ["id_original_query", "request_key", "slice_no"]
    classes = []
    if profile.named or profile.in_part:
        wanted = prepared.drop("_times", "_cells")
        whole, part = wanted.filter("_whole IS NOT NULL"), wanted.filter(_by_part())
        if profile.in_part:
            part = _names_of_parts(part, catalog, profile.in_part <= broadcast_keys)
            whole = whole.unionByName(part) if profile.named else part
        small = strategy == "broadcast" or (strategy == "auto" and not profile.in_part and profile.named <= broadcast_keys)
        classes.append(_search_by_name(whole, catalog, profile, small, rows_per_slot, pairs_per_slot))
    if profile.others or not classes:
        if classes:
            requests = requests.join(prepared.filter(F.col("_whole").isNull() & ~_by_part()).select(*_request_id(requests)).distinct(), _request_id(requests), "left_semi")
            prepared = prepare_requests(requests, mode, cell_degrees)
            profile = profile_requests(prepared)
        span = None
        if profile.has_open:
            span = catalog_span(_prune(catalog, profile))
            prepared = prepare_requests(requests, mode, cell_degrees, span)
            profile = profile_requests(prepared)
        classes.append(_search_by_day(prepared, catalog, profile, span, strategy, cell_degrees, rows_per_slot, broadcast_keys, pairs_per_slot, by_name and not classes))
    parts = [c.select(*tags, *[x for x in catalog.columns if x not in tags]) for c in classes]
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found if top is None else cap_per_request(found, top)


def _request_id(requests: DataFrame) -> list[str]:
    return [c for c in ("request_key", "slice_no") if c in requests.columns]


def _search_by_day(
    prepared: DataFrame,
    catalog: DataFrame,
    profile: RequestProfile,
    span: tuple[int, int] | None,
    strategy: str,
    cell_degrees: float,
    rows_per_slot: int,
    broadcast_keys: int,
    pairs_per_slot: int,
    by_name: bool = False,
) -> DataFrame:
    """Pairs that share a time key and a cell."""
    if profile.day_keys <= broadcast_keys:
        # few enough single days: products then need no second key for the blocks
        profile = replace(profile, keys=profile.day_keys, has_blocks=False)
        prepared = prepared.withColumn("_times", _time_keys(False))
    if strategy == "auto":
        strategy = "broadcast" if profile.keys <= broadcast_keys else "shuffle"
    if strategy == "broadcast" and by_name:
        pairs, products = _pairs_by_time(prepared, catalog, profile, span)
        if pairs > products:  # else the pairs are fewer than the products that would be dealt
            tasks = max(int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-pairs // PAIRS_PER_TASK), MOST_TASKS))
            catalog = catalog.repartition(tasks, "Name")
    # outer explodes: a null key never joins, and no filter over the whole key expression is derived
    req = prepared.withColumn("_time", F.explode_outer("_times")).withColumn("_cell", F.explode_outer("_cells"))
    req = _flat_keys(req.drop("_times", "_cells"))
    products = _flat_keys(_prepare_catalog(_prune_months(catalog, prepared, profile), profile, cell_degrees, span))
    shared = G.shared_cell(F.col("box"), F.col("_area_box"), cell_degrees)
    condition = _asked(profile, (F.col("_cx") == shared["cx"]) & (F.col("_cy") == shared["cy"]))
    if strategy == "broadcast":
        return products.join(F.broadcast(req), _KEYS, "inner").filter(condition)
    asked_by = ["request_key", "slice_no"]
    return grid_join(products, req, _KEYS, rows_per_slot, pairs_per_slot, condition, ["Id"], asked_by)


def _search_by_name(
    requests: DataFrame, catalog: DataFrame, profile: RequestProfile, small: bool, rows_per_slot: int, pairs_per_slot: int
) -> DataFrame:
    """Pairs of requests for whole names (``_whole``) and products of that name; no day and no cell takes part in the join."""
    df = _prune(catalog, profile) if not profile.others else catalog
    df = df.withColumn("_modes", _attribute_values(catalog, "operationalMode")).withColumn("_types", _attribute_values(catalog, "productType"))
    if profile.has_area:
        df = with_geometry(df).withColumn("_geom_is_box", G.is_box("geom"))
    # a name inside a longer one is asked for by the request too
    inner = F.nullif(whole_name("Name"), F.col("Name"))
    names = F.array(F.struct(F.col("Name").alias("n"), F.lit(False).alias("i")), F.struct(inner.alias("n"), F.lit(True).alias("i")))
    df = df.withColumn("_n", F.explode(F.filter(names, lambda x: x["n"].isNotNull())))
    df = df.select("*", F.col("_n.n").alias("_whole"), F.col("_n.i").alias("_inner")).drop("_n")
    requests = requests.withColumn("_in_part", _by_part_of())
    condition = _asked(profile, F.lit(True)) & ~(F.col("_inner") & F.col("_in_part"))
    if small:
        return df.join(F.broadcast(requests), "_whole", "inner").filter(condition)
    return grid_join(df, requests, ["_whole"], rows_per_slot, pairs_per_slot, condition, ["Id"], ["request_key", "slice_no"])


def _by_part_of() -> Column:
    """The request's whole name was found for a part of it."""
    return F.col("_whole") != F.col("_name")


def _grams(text: str) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, F.lit(GRAM))))


def _names_of_parts(requests: DataFrame, catalog: DataFrame, small: bool) -> DataFrame:
    """Requests by a part of a name, once for each name of the catalog that holds the part, which becomes ``_whole``.

    A part is looked up by that one of its ``GRAM``-character pieces that fewest names hold.
    """
    held = catalog.select("Name").distinct().filter(F.length("Name") >= GRAM).select("Name", F.explode(_grams("Name")).alias("_gram"))
    parts = requests.select("_name").distinct().select("_name", F.explode(_grams("_name")).alias("_gram"))
    asked = parts.select("_gram").distinct()
    asked = F.broadcast(asked) if small else asked
    counts = held.join(asked, "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = parts.join(counts, "_gram", "left").groupBy("_name").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)), "_gram"))["_gram"].alias("_gram"))
    rarest = F.broadcast(rarest) if small else rarest
    names = held.join(rarest, "_gram").filter(F.col("Name").contains(F.col("_name"))).select("_name", F.col("Name").alias("_found"))
    return requests.join(names, "_name").withColumn("_whole", F.col("_found")).select(*requests.columns)


_KEYS = ["_level", "_bucket", "_cx", "_cy"]


def _flat_keys(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("_time", "_cell")],
        F.col("_time")["level"].alias("_level"),
        F.col("_time")["bucket"].alias("_bucket"),
        F.col("_cell")["cx"].alias("_cx"),
        F.col("_cell")["cy"].alias("_cy"),
    )


def cap_per_request(found: DataFrame, top: int = K.DEFAULT_TOP) -> DataFrame:
    """First ``top`` rows of each request slice; ``capped`` tells that the limit was reached."""
    slice_key = ["id_original_query", "request_key", "slice_no"]
    order = Window.partitionBy(*slice_key).orderBy("content_start", "Id")
    kept = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top)
    last = Window.partitionBy(*slice_key)
    return kept.withColumn("capped", F.max("_rank").over(last) == top).drop("_rank")


# --------------------------------------------------------------------- after the join
def latest_versions(found: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Most recently modified row of each Name (per ``by``, default ``id_original_query`` if present).

    The rank limit runs before and after the shuffle, so copies of one name meet as
    at most one row per input partition.
    """
    if by is None:
        by = ["id_original_query"] if "id_original_query" in found.columns else []
    order = Window.partitionBy(*by, "Name").orderBy(F.col("ModificationDate").desc_nulls_last(), "Id")
    return found.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def drop_missing_ids(found: DataFrame) -> DataFrame:
    return found.na.drop(subset=["Id"])


def require_names(found: DataFrame) -> DataFrame:
    """Fail at run time as soon as a product without Name is met."""
    checked = F.when(F.col("Name").isNull(), F.raise_error(F.lit("Name field contains null"))).otherwise(F.col("Name"))
    return found.withColumn("Name", checked)


def missing_names(found: DataFrame) -> DataFrame:
    return found.agg(F.count_if(F.col("Name").isNull()).alias("missing_names"))


def products_per_query(found: DataFrame) -> DataFrame:
    """Number of products of each ``id_original_query``."""
    return found.groupBy("id_original_query").agg(F.count(F.lit(1)).alias("n_products"))


def search_counters(requests: DataFrame, found: DataFrame, top: int = K.DEFAULT_TOP) -> DataFrame:
    """Counters of a search run as (counter, n), before versions are merged."""
    normalized = requests if "id_original_query" in requests.columns else normalize_requests(requests)
    if "slice_no" not in normalized.columns:
        normalized = normalized.withColumn("slice_no", F.lit(0).cast("bigint"))
    per_slice = found.groupBy(
        F.col("request_key").alias("_k"), F.col("slice_no").alias("_s")
    ).agg(F.count(F.lit(1)).alias("_n"))
    asked = normalized.select("request_key", "slice_no")
    joined = asked.join(
        per_slice, (asked["request_key"] == per_slice["_k"]) & (asked["slice_no"] == per_slice["_s"]), "left"
    )
    n = F.coalesce("_n", F.lit(0))
    counts = joined.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("product_proposed"),
        F.count_if(n > 0).alias("answer_append"),
        F.count_if(n == 0).alias("nodata_answer"),
        F.count_if(n >= top).alias("capped_answer"),
    )
    return counts.unpivot([], counts.columns, "counter", "n")


def published_after(
    catalog: DataFrame, since, unit: str, product_type: str, cap: int | None = None
) -> DataFrame:
    """Products of a unit and type published since a date.

    With ``cap``, the earliest published so many, and ``capped``, which tells that there are more.
    """
    found = _published(catalog, since, unit, product_type)
    if cap is None:
        return found
    first = found.orderBy("PublicationDate", "Id").limit(cap + 1)
    rank = F.row_number().over(Window.orderBy("PublicationDate", "Id"))  # over cap + 1 rows
    more = F.max("_rank").over(Window.partitionBy(F.lit(1))) > cap
    return first.withColumn("_rank", rank).withColumn("capped", more).filter(F.col("_rank") <= cap).drop("_rank")


def published_after_total(catalog: DataFrame, since, unit: str, product_type: str) -> DataFrame:
    """Exact number of products behind ``published_after``."""
    return _published(catalog, since, unit, product_type).agg(F.count(F.lit(1)).alias("total"))


def _published(catalog: DataFrame, since, unit: str, product_type: str) -> DataFrame:
    return catalog.filter(
        (F.col("PublicationDate") > F.lit(since).cast("timestamp"))
        & F.col("Name").startswith(unit)
        & F.array_contains(_attribute_values(catalog, "productType"), product_type)
    )


def filter_names(
    catalog: DataFrame,
    prefix: str | None = None,
    contains: list[str] | None = None,
    excludes: list[str] | None = None,
) -> DataFrame:
    """Literal name filters (prefix, parts, excluded parts); these reach a Parquet scan."""
    cond = F.lit(True)
    if prefix:
        cond = cond & F.col("Name").startswith(prefix)
    for part in contains or []:
        cond = cond & F.col("Name").contains(part)
    for part in excludes or []:
        cond = cond & ~F.col("Name").contains(part)
    return catalog.filter(cond)


def common_products(found: DataFrame, first: str, second: str) -> DataFrame:
    """How many rows of query ``first`` have an Id that query ``second`` also returned.

    One aggregation per Id with partial sums: no join, however often an Id repeats.
    """
    is_first = F.col("id_original_query") == first
    is_second = F.col("id_original_query") == second
    per_id = (
        found.filter(is_first | is_second)
        .groupBy("Id")
        .agg(F.count_if(is_first).alias("n"), F.max(is_second).alias("both"))
    )
    return per_id.agg(
        F.coalesce(F.sum(F.when(F.col("both"), F.col("n"))), F.lit(0)).alias("common"),
        F.coalesce(F.sum(F.when(~F.col("both"), F.col("n"))), F.lit(0)).alias("uncommon"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def products_in_both(found: DataFrame, first: str, second: str, both: bool = True) -> DataFrame:
    """Rows of query ``first`` whose Id query ``second`` also has (or has not)."""
    other = found.filter(F.col("id_original_query") == second).select("Id").distinct()
    mine = found.filter(F.col("id_original_query") == first)
    return mine.join(other, "Id", "left_semi" if both else "left_anti")


def attribute_value(df: DataFrame, name: str, alias: str | None = None) -> DataFrame:
    """Flatten one attribute into a column."""
    return df.withColumn(alias or name, N.attribute("Attributes", name))
