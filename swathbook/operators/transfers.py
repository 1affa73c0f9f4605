"""Statistics over transfer logs and object listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.operators.skew import ROWS_PER_SLOT, skew_join

#: A whole path segment that names a product.
PRODUCT_SEGMENT = r"(?:^|/)([^/]+[.]SAFE)(?:/|$)"


def _ok():
    return F.col("status_meaning").isin(K.SUCCESS_MEANINGS)


def transfer_summary(log: DataFrame) -> DataFrame:
    """Speed, duration and size of the successful transfers (population deviations, GB = MB/1024)."""
    return log.filter(_ok()).agg(
        F.count(F.lit(1)).alias("successful_download"),
        F.avg("speed").alias("mean_speed"),
        F.stddev_pop("speed").alias("std_speed"),
        F.avg("elapsed_time").alias("mean_elapsed"),
        F.stddev_pop("elapsed_time").alias("std_elapsed"),
        (F.sum("total_mb") / 1024.0).alias("total_gb"),
        (F.avg("total_mb") / 1024.0).alias("mean_gb"),
    )


def transfer_status(log: DataFrame) -> DataFrame:
    """Finished transfers per meaning, flagged as failed or not."""
    return (
        log.filter(F.col("status_meaning").isNotNull())
        .groupBy("status_meaning")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("failed", ~_ok())
    )


def errors_per_login(log: DataFrame, limit: int = K.MAX_LOGIN_ERRORS) -> DataFrame:
    """Failed transfers per batch and login; logins reaching ``limit`` are flagged."""
    return (
        log.filter(F.col("status_meaning").isNotNull() & ~_ok())
        .groupBy("batch", "login")
        .agg(F.count(F.lit(1)).alias("n_errors"))
        .withColumn("blacklisted", F.col("n_errors") >= limit)
    )


def transfer_eta(log: DataFrame) -> DataFrame:
    """Speed range of the successes and the estimated time for what is left.

    Left are rows with status 0 (to do) or 2 (running); at least one runs in parallel.
    """
    done = _ok() & ~F.col("status").isin(K.STATUS_TODO, K.STATUS_RUNNING)
    df = log.agg(
        F.avg(F.when(done, F.col("speed"))).alias("avg_speed"),
        F.min(F.when(done, F.col("speed"))).alias("min_speed"),
        F.max(F.when(done, F.col("speed"))).alias("max_speed"),
        F.avg(F.when(done, F.col("elapsed_time"))).alias("_avg_t"),
        F.count_if(F.col("status").isin(K.STATUS_TODO, K.STATUS_RUNNING)).alias("remaining"),
        F.greatest(F.count_if(F.col("status") == K.STATUS_RUNNING), F.lit(1)).alias("parallel"),
    )
    df = df.withColumn(
        "eta_seconds", F.floor(F.col("_avg_t") * F.col("remaining") / F.col("parallel")).cast("bigint")
    )
    eta = F.col("eta_seconds")
    hours = F.concat(
        F.floor(eta / 3600).cast("string"), F.lit("h"), F.lpad(F.floor(eta % 3600 / 60).cast("string"), 2, "0"), F.lit("m")
    )
    minutes = F.concat(
        F.floor(eta / 60).cast("string"), F.lit("m"), F.lpad((eta % 60).cast("string"), 2, "0"), F.lit("s")
    )
    text = F.when(eta >= 3600, hours).otherwise(minutes)
    return df.withColumn("eta", text).drop("_avg_t")


def object_manifest(
    listing: DataFrame, objects: DataFrame, name: str = "safename", rows_per_slot: int = ROWS_PER_SLOT
) -> DataFrame:
    """Per listed product: number of objects, bytes, MB, and single / multi / NotFound.

    Objects are summed per product segment of their key before they meet the listing.
    """
    product = F.regexp_extract("key", PRODUCT_SEGMENT, 1)
    sums = objects.groupBy(product.alias(name)).agg(
        F.count(F.lit(1)).alias("n_objects"), F.sum("size").alias("total_bytes")
    )
    df = skew_join(listing, sums, [name], "left", rows_per_slot)
    n = F.coalesce("n_objects", F.lit(0))
    return (
        df.withColumn("n_objects", n)
        .withColumn("total_bytes", F.coalesce("total_bytes", F.lit(0)))
        .withColumn("total_mb", F.col("total_bytes") / 1e6)
        .withColumn(
            "layout", F.when(F.col("n_objects") == 0, "NotFound").when(F.col("n_objects") == 1, "single").otherwise("multi")
        )
    )


def object_local_paths(objects: DataFrame, outdir: str) -> DataFrame:
    """Local file of each object under its product; folder markers are skipped."""
    product = F.regexp_extract("key", PRODUCT_SEGMENT, 1)
    inside = F.regexp_extract("key", r"(?:^|/)[^/]+[.]SAFE/(.*)$", 1)
    local = F.concat_ws("/", F.lit(outdir.rstrip("/")), product, F.nullif(inside, F.lit("")))
    return (
        objects.filter(~F.col("key").endswith("/") & F.col("key").rlike(PRODUCT_SEGMENT))
        .select("key", product.alias("safename"), inside.alias("relative_path"), local.alias("local_path"), "size")
    )
