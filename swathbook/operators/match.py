"""Sibling products of another type, nearest in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import names as N
from swathbook.functions import paths as P
from swathbook.operators.once import computed_once
from swathbook.operators.skew import ROWS_PER_SLOT, skew_join

_GROUP = ["_unit", "_orbit_take", "_level_pol"]
BUCKET_SECONDS = 3600


def _sources(listing: DataFrame, name: str, target_type: str, raw_level: str) -> DataFrame:
    df = listing.select(
        F.col(name).alias("source_id"),
        *[F.col(c) for c in listing.columns if c not in (name, "source_id")],
        F.unix_seconds(N.s1_start(name)).alias("_start"),
    )
    fields = N.s1_fields("source_id")
    known = {
        "_unit": F.get(F.split("source_id", "_"), 0),
        "_orbit_take": F.concat_ws("_", fields["absolute_orbit_number"], fields["mission_data_take"]),
        "_level_pol": F.concat(N.target_level(target_type, raw_level), F.lit("S"), fields["polarisation"]),
        "_take": fields["mission_data_take"],
    }
    df = computed_once(df, {c: F.col(c) for c in ("source_id", "_start")})
    columns = {k: F.when(F.col("_start").isNotNull(), v) for k, v in known.items()}
    columns["_text"] = N.name_time_text(F.timestamp_seconds("_start"))
    return computed_once(df, columns).withColumn("_error", N.name_error("source_id"))


def _candidates(catalog: DataFrame, target_type: str) -> DataFrame:
    fields = N.s1_fields("Name")
    wanted = catalog.filter(
        (F.substring("Name", 7, 5) == F.concat(F.lit("_"), N.type_token(target_type))) & ~F.col("Name").contains("_COG")
    ).select("Name", "Id", "ContentLength")
    return computed_once(wanted, {"Name": F.col("Name")}).select(
        F.get(F.split("Name", "_"), 0).alias("_unit"),
        F.substring("Name", 50, 13).alias("_orbit_take"),
        F.substring("Name", 13, 4).alias("_level_pol"),
        F.unix_seconds(fields["startdate"]).alias("_cstart"),
        F.struct("Name", "Id", "ContentLength").alias("_c"),
        "Name",
    )


def _by_name(df: DataFrame, keys: list[str]) -> DataFrame:
    """The candidate first by name (then id) per key: a small row per key, partly merged before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("_c")["Name"], F.col("_c")["Id"])
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def _exact(candidates: DataFrame) -> DataFrame:
    """Candidates by every time text that occurs in their name."""
    texts = F.array_distinct(
        F.regexp_extract_all("Name", F.lit(r"(?=(\d{8}T\d{6}))"), F.lit(1))
    )
    keyed = candidates.withColumn("_text", F.explode(texts)).drop("Name", "_cstart")
    return _by_name(keyed, _GROUP + ["_text"])


def _nearest(sources: DataFrame, candidates: DataFrame, bucket_seconds: int) -> DataFrame:
    """Nearest candidate for every distinct (group, start second) of the sources.

    Both sides shrink to one row per group and second first. Neighbours are looked
    up inside time buckets (at most ``bucket_seconds`` seconds each); for what lies
    beyond a bucket, each bucket is summed up by its first and last candidate and
    only these summaries are ordered along the group. No pairs are formed and no
    group of products is gathered.
    """
    # names without a readable time collapse to one row here and never join
    wanted = sources.select(*_GROUP, F.col("_start").alias("_t")).distinct()
    known = _by_name(candidates.filter("_cstart IS NOT NULL").drop("Name"), _GROUP + ["_cstart"])
    known = known.withColumnRenamed("_cstart", "_t")
    event = F.struct(F.col("_t").alias("t"), F.col("_c").alias("c"))
    both = known.select(*_GROUP, "_t", event.alias("_cand"), F.lit(False).alias("_asks")).unionByName(
        wanted.select(*_GROUP, "_t", F.lit(True).alias("_asks")), allowMissingColumns=True
    )
    both = both.withColumn("_bucket", F.floor(F.col("_t") / bucket_seconds))

    # both directions look back over rows already seen, once per sort order: linear in the rows
    inside = Window.partitionBy(*_GROUP, "_bucket")
    before = inside.orderBy(F.asc("_t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = inside.orderBy(F.desc("_t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        both.withColumn("_prev", F.last("_cand", ignorenulls=True).over(before))
        .withColumn("_next", F.last("_cand", ignorenulls=True).over(after))
        .filter("_asks")
        .select(*_GROUP, "_bucket", "_t", "_prev", "_next")
    )

    # one row per group and bucket: edges of its candidates, looked up along the group
    time_of = F.col("_cand")["t"]
    edges = both.groupBy(*_GROUP, "_bucket").agg(
        F.min_by("_cand", time_of).alias("_first"), F.max_by("_cand", time_of).alias("_last")
    )
    along = Window.partitionBy(*_GROUP)
    earlier = along.orderBy(F.asc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    later = along.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        edges.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
        .withColumn("_after", F.last("_first", ignorenulls=True).over(later))
        .drop("_first", "_last")
    )
    seen = local.join(edges, _GROUP + ["_bucket"], "left")
    low, high = F.coalesce("_prev", "_before"), F.coalesce("_next", "_after")
    lag, lead = F.col("_t") - low["t"], high["t"] - F.col("_t")
    take_low = high.isNull() | (lag < lead) | ((lag == lead) & (low["c"]["Name"] <= high["c"]["Name"]))
    best = F.when(low.isNotNull() & take_low, low).otherwise(high)
    return (
        seen.withColumn("_best", best)
        .filter("_best IS NOT NULL")
        .select(
            *_GROUP,
            F.col("_t").alias("_start"),
            F.col("_best")["c"].alias("_near"),
            F.abs(F.col("_t") - F.col("_best")["t"]).alias("_delta"),
        )
    )


def match_siblings(
    listing: DataFrame,
    catalog: DataFrame,
    target_type: str,
    name: str = "safename",
    tolerance: float = K.MAX_DELTA_SECONDS,
    mode: str = "default",
    bucket_seconds: int = BUCKET_SECONDS,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """For every listed product its sibling of ``target_type`` of the same unit, orbit, datatake and polarisation.

    A candidate whose name holds the source's start time anywhere wins
    (``exact_timestamp``, first by name); otherwise the nearest start within
    ``tolerance`` seconds (``closest_in_time``; ties by name). ``status`` is found,
    not_found or error; ``delta_seconds`` is 0 for exact matches and also given
    beyond the tolerance. ``mode="reference"`` looks for RAW_ products at level 1.
    """
    if target_type not in K.TARGET_TYPES:
        raise ValueError(f"unknown target type {target_type!r}, expected one of {K.TARGET_TYPES}")
    src = _sources(listing, name, target_type, "1" if mode == "reference" else "0")
    asked = src.filter("_start IS NOT NULL").select(*_GROUP).distinct()
    cand = _candidates(catalog, target_type).join(asked, _GROUP, "left_semi")  # only groups of the listing

    exact = _exact(cand).select(*_GROUP, "_text", F.col("_c").alias("_exact"))
    near = _nearest(src, cand, bucket_seconds)
    groups = cand.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_n"))
    # answers per distinct (group, start); the listing is joined once, with hot starts split
    starts = src.select(*_GROUP, "_start", "_text").distinct()
    answers = (
        skew_join(starts, groups, _GROUP, "left", rows_per_slot)
        .join(exact, _GROUP + ["_text"], "left")
        .join(near, _GROUP + ["_start"], "left")
        .drop("_text")
    )
    df = skew_join(src.drop("_text"), answers, _GROUP + ["_start"], "left", rows_per_slot)

    is_exact = F.col("_exact").isNotNull()
    within = F.col("_delta") <= tolerance
    chosen = F.when(is_exact, F.col("_exact")).when(within, F.col("_near"))
    status = (
        F.when(F.col("_error").isNotNull() | F.col("_start").isNull(), "error")
        .when(chosen.isNotNull(), "found")
        .when(F.col("_n").isNotNull() & F.col("_near").isNull(), "error")
        .otherwise("not_found")
    )
    # Texts of the notes.
    none_found = F.concat(F.lit(f"No {target_type} product found for DataTake "), F.col("_take"))
    too_far = F.concat(
        F.lit(f"Closest {target_type} product is "),
        F.col("_delta").cast("string"),
        F.lit(f"s away (>{tolerance}s threshold): "),
        F.col("_near")["Name"],
    )
    note = (
        F.when(F.col("_error").isNotNull(), F.col("_error"))
        .when(F.col("_start").isNull(), "not a radar product name")
        .when(chosen.isNotNull(), F.lit(None).cast("string"))
        .when(F.col("_n").isNull(), none_found)
        .when(F.col("_near").isNull(), "no candidate with a readable start time")
        .otherwise(too_far)
    )
    extra = [c for c in listing.columns if c not in (name, "source_id")]
    found = F.col("_chosen")
    return (
        df.withColumn("_chosen", chosen)
        .select(
            "source_id",
            *extra,
            found["Id"].alias("target_id"),
            found["Name"].alias("target_name"),
            F.when(found.isNotNull(), target_type).alias("target_type"),
            F.when(found.isNotNull(), F.when(is_exact, "exact_timestamp").otherwise("closest_in_time")).alias(
                "match_method"
            ),
            N.size_mb(found["ContentLength"]).alias("size_mb"),
            P.download_url(found["Id"], K.MATCH_URL).alias("download_url"),
            status.alias("status"),
            note.alias("note"),
            F.when(is_exact, F.lit(0).cast("bigint")).otherwise(F.col("_delta")).alias("delta_seconds"),
        )
    )


def unprocessed(listing: DataFrame, done: DataFrame, name: str = "safename", done_name: str = "source_id") -> DataFrame:
    """Listed names an earlier run has not treated; repeated names survive.

    The earlier names are reduced to distinct ones before the join.
    """
    treated = done.select(F.col(done_name).alias(name), F.lit(True).alias("_done")).distinct()
    return skew_join(listing, treated, [name], "left").filter("_done IS NULL").drop("_done")


def match_report(matches: DataFrame) -> DataFrame:
    """One text line per source: the target name, or a NOT_FOUND remark."""
    remark = F.concat(
        F.lit("# NOT_FOUND: "), F.col("source_id"), F.lit(" — "), F.coalesce("note", F.lit(""))
    )
    return matches.select(F.coalesce("target_name", remark).alias("line"))


def match_delta_histogram(matches: DataFrame, tolerance: float = K.MAX_DELTA_SECONDS) -> DataFrame:
    """Matches per whole second of distance, also beyond the tolerance; sorted by distance."""
    delta: Column = F.floor("delta_seconds").cast("bigint")
    return (
        matches.filter("delta_seconds IS NOT NULL")
        .groupBy(delta.alias("delta"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("delta", "n", (F.col("delta") > tolerance).alias("above_threshold"))
        .orderBy("delta")
    )


def match_summary(matches: DataFrame) -> DataFrame:
    return matches.agg(
        F.count_if(F.col("status") == "found").alias("found"),
        F.count_if(F.col("status") == "not_found").alias("not_found"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
