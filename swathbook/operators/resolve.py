"""From names to ids and paths, and the check of listed paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathbook.functions import paths as P
from swathbook.operators.requests import normalize_requests, requests_from_names
from swathbook.operators.search import latest_versions, search


def first_per_name(df: DataFrame, name: str, order: list) -> DataFrame:
    """One row per name, the first in ``order``; partly merged before the shuffle."""
    w = Window.partitionBy(name).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def resolve_ids(listing: DataFrame, catalog: DataFrame, name: str = "safename", line: str = "line_no") -> DataFrame:
    """(``line_no``, ``id``, ``safename``, ``S3Path``): each listed name once, unknown names with null id.

    Repeated names keep their first line; of several products with one name the
    lowest Id counts. The catalog is cut to the listed names before it is made unique.
    """
    wanted = first_per_name(listing.select(line, name), name, [line])
    asked = catalog.select("Id", F.col("Name").alias(name), "S3Path").join(wanted.select(name), name, "left_semi")
    known = asked.groupBy(name).agg(F.min(F.struct("Id", "S3Path")).alias("_first")).select(name, "_first.Id", "_first.S3Path")
    return wanted.join(known, name, "left").select(
        line, F.col("Id").alias("id"), name, P.strip_bucket("S3Path").alias("S3Path")
    )


def search_listing(
    listing: DataFrame, catalog: DataFrame, private_units: list[str] | None = None, name: str = "safename", line: str = "line_no", mode: str = "default"
) -> DataFrame:
    """(``line_no``, ``id``, ``safename``, ``S3Path``) of listed names found by searching: listing, requests, search, ids.

    Each name becomes a request with its window, mode and product type (with the suffix of ``private_units``), and the
    latest version of what is found counts. Names that are not found, or are no radar product names, are left out;
    a repeated name has its first line.
    """
    if line not in listing.columns:
        listing = listing.select(name).distinct().withColumn(line, F.lit(None).cast("long"))
    lines = listing.groupBy(name).agg(F.min(line).alias(line))
    requests = requests_from_names(lines.select(name), name, private_units, mode)
    found = latest_versions(search(normalize_requests(requests), catalog))
    found = found.select(F.col("Name").alias(name), F.col("Id").alias("id"), P.strip_bucket("S3Path").alias("S3Path"))
    return lines.join(found, name).select(line, "id", name, "S3Path")


def path_audit(products: DataFrame, name: str = "Name", path: str = "S3Path") -> DataFrame:
    """Expected and listed path per product with ``verdict`` OK or KO."""
    expected, listed = P.object_path(name), P.strip_bucket(path)
    return products.select(
        F.col(name).alias("safename"),
        expected.alias("expected_path"),
        listed.alias("listed_path"),
        F.when(F.coalesce(expected == listed, F.lit(False)), "OK").otherwise("KO").alias("verdict"),
    )


def path_audit_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
