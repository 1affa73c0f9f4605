"""Incremental runs: new documents into the stored catalog, new listings into the match table.

The checkpoint of the query remembers which files were treated, so a run that
stopped continues where it was and treats nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swathbook import schemas as S
from swathbook.operators.match import match_siblings, unprocessed
from swathbook.sources.readers import flatten_products
from swathbook.sources.writers import catalog_layout


def ingest_catalog(spark: SparkSession, documents: str, catalog_path: str, checkpoint: str) -> StreamingQuery:
    """Append the products of response documents that arrived since the last run, then stop."""
    stream = spark.readStream.schema(S.RESPONSE_DOCUMENT).option("multiLine", True).json(documents)
    return (
        catalog_layout(flatten_products(stream))
        .writeStream.format("parquet")
        .partitionBy("collection", "start_month")
        .option("path", catalog_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def match_new_listings(
    spark: SparkSession,
    listings: str,
    catalog: DataFrame,
    target_type: str,
    results_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Match the names of listing files that arrived since the last run, then stop.

    Each micro-batch writes its own ``batch`` partition and replaces it when it is
    repeated after a failure. Names matched in earlier batches are skipped.
    """
    names = (
        spark.readStream.text(listings)
        .select(F.trim("value").alias("safename"))
        .filter(F.length("safename") > 0)
    )

    def treat(batch: DataFrame, number: int) -> None:
        todo = batch
        earlier = _earlier_results(spark, results_path, number)
        if earlier is not None:
            todo = unprocessed(todo, earlier)
        (
            match_siblings(todo, catalog, target_type)
            .withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(results_path)
        )

    return (
        names.writeStream.foreachBatch(treat)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _earlier_results(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    if number == 0:
        return None
    # a schema of its own: earlier batches without names leave no file to take one from
    return spark.read.schema("source_id string, batch int").parquet(path).filter(F.col("batch") < number)
