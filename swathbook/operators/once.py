"""Columns that are evaluated exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add long expressions as columns that later filters and joins refer to instead of repeating.

    Filters (also those derived from join keys) are moved below projections by
    copying the projected expression into them. The output of an explode stays where
    it is, so a one-element explode keeps parsed geometries and names from being
    parsed again for every condition that mentions them.
    """
    packed = F.explode_outer(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))
    kept = [c for c in df.columns if c not in columns]
    return df.withColumn("_once", packed).select(*kept, *[F.col("_once")[k].alias(k) for k in columns])


def held(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` in the session's checkpoint folder, so that it is computed once and outlives its executors.

    Without such a folder (as in tests) ``df`` itself, which is then computed again for each use.
    """
    sc = df.sparkSession.sparkContext
    return df.checkpoint() if sc.getCheckpointDir() else df
