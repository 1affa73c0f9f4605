"""Which listed products are already held locally, from a table of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import paths as P
from swathbook.operators.skew import ROWS_PER_SLOT, skew_join

ARCHIVE, SPOOL, OUTDIR, ABSENT = "archive", "spool", "outdir", "absent"


def _spots(archives: list[str], spools: list[str], outdir: str, name: str) -> Column:
    """Every path under which a name may lie, as an array of ``tier``, ``rank`` (order of preference) and ``path``."""
    places = []
    for root in archives:
        folder = P.archive_dir(name, root.rstrip("/"))
        places.append((ARCHIVE, F.concat(folder, F.lit("/"), F.col(name))))
    for root in spools:
        places.append((SPOOL, F.concat(F.lit(root.rstrip("/") + "/"), F.col(name))))
    places.append((OUTDIR, F.concat(F.lit(outdir.rstrip("/") + "/"), F.col(name))))

    def ranked(k: int, tier: str, path: Column) -> Column:
        return F.transform(
            P.name_variants(path),
            lambda p, i: F.struct(F.lit(tier).alias("tier"), (i + 3 * k).alias("rank"), p.alias("path")),
        )

    return F.flatten(F.array(*[ranked(k, tier, path) for k, (tier, path) in enumerate(places)]))


def expected_paths(
    names: DataFrame, archives: list[str], spools: list[str], outdir: str, name: str = "safename"
) -> DataFrame:
    """Every path under which a name may lie: ``tier``, ``rank`` (order of preference), ``path``."""
    return (
        names.select(name, F.explode(_spots(archives, spools, outdir, name)).alias("_spot"))
        .select(name, F.col("_spot.tier"), F.col("_spot.rank"), F.col("_spot.path"))
        .filter("path IS NOT NULL")
    )


def _stem(path: str) -> Column:
    """What all variants of a name have in common: its last part without endings."""
    return F.replace(F.replace(P.base_name(path), F.lit(".SAFE"), F.lit("")), F.lit(".zip"), F.lit(""))


def locate(
    listing: DataFrame,
    files: DataFrame,
    archives: list[str],
    spools: list[str],
    outdir: str,
    extension: str = ".zip",
    force: bool = False,
    name: str = "safename",
    url_template: str = K.ZIPPER_URL,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add to each listed product: ``tier`` (first that holds it, else absent), ``found_path``,
    ``to_download``, ``output_path`` and, when the listing has ids, ``url``.

    Names and files are made distinct first and joined once, on the bare name; the places of a name are worked out for
    the files that bear it. ``force`` downloads everything but keeps the tier.
    """
    names = listing.select(name).filter(F.col(name).isNotNull()).distinct()
    held = files.select("path").distinct().withColumn("_stem", _stem("path"))
    spot = F.get(F.filter(_spots(archives, spools, outdir, name), lambda s: s["path"] == F.col("path")), 0)
    hits = (
        names.withColumn("_stem", _stem(name)).join(held, "_stem", "inner")
        .select(name, spot.alias("_spot"))
        .filter("_spot IS NOT NULL")
        .groupBy(name)
        .agg(F.min(F.struct("_spot.rank", "_spot.tier", "_spot.path")).alias("_hit"))
        .select(name, F.col("_hit.tier").alias("_tier"), F.col("_hit.path").alias("found_path"))
    )
    df = skew_join(listing, hits, [name], "left", rows_per_slot)
    df = df.withColumn("tier", F.coalesce("_tier", F.lit(ABSENT))).drop("_tier")
    df = df.withColumn("to_download", F.lit(True) if force else F.col("tier") == ABSENT)
    df = df.withColumn("output_path", P.output_path(name, outdir, extension))
    if "id" in listing.columns:
        df = df.withColumn("url", P.download_url("id", url_template))
    return df


def presence_summary(located: DataFrame) -> DataFrame:
    """Counters as (counter, n): listing size, each tier, and hits per archive prefix."""
    prefix = F.array_join(F.slice(F.split("found_path", "/"), 1, 3), "-")
    keys = F.array_compact(
        F.array(
            F.lit(K.COUNT_LISTING),
            F.when(F.col("tier") == ARCHIVE, K.COUNT_ARCHIVED)
            .when(F.col("tier") == SPOOL, K.COUNT_SPOOL)
            .when(F.col("tier") == OUTDIR, K.COUNT_OUTDIR)
            .otherwise(K.COUNT_ABSENT),
            F.when(F.col("tier") == ARCHIVE, F.concat(F.lit(K.COUNT_ARCHIVE_PREFIX), prefix)),
        )
    )
    return located.select(F.explode(keys).alias("counter")).groupBy("counter").agg(F.count(F.lit(1)).alias("n"))


def download_listing(located: DataFrame) -> DataFrame:
    """(``safe`` [, ``id``]) of the products to fetch, names taken back from their output paths."""
    columns = [P.base_name("output_path").alias("safe")] + ([F.col("id")] if "id" in located.columns else [])
    return located.filter("to_download").select(*columns)
