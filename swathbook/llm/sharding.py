"""Sharding along a Hilbert curve, for files that prune on several metadata columns at once.

Each dimension is cut into 2 ** BITS cells of about equal numbers of rows, the cells of a row are a point of a grid,
and rows are ordered by the point's index on the Hilbert curve through the grid. Shards are runs of that order with
nearly equal bytes. Neighbours on the curve are neighbours in every dimension, so that each shard covers a small range
of all of them.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swathbook.llm.shared import running_total, write_table

#: Cells of a dimension: 2 ** BITS.
BITS = 4
SHARDS = 8


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a grid point on the Hilbert curve, by Skilling's transform of its coordinates."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    index = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            index = index << 1 | (v >> b & 1)
    return index


def curve(dimensions: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(cell, index) of all grid points; a cell's number has the coordinates one after the other, the first on top."""
    out = []
    for point in product(range(1 << bits), repeat=dimensions):
        cell = 0
        for v in point:
            cell = cell << bits | v
        out.append((cell, hilbert_index(point, bits)))
    return out


def cells(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """value and cell of each distinct value: the share of rows with smaller values, in 2 ** bits steps (null first)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed = running_total(counts.select(F.col("value").isNotNull().alias("known"), "value", "n"), ["known", "value"], "n")
    rows = counts.agg(F.sum("n").alias("rows"))
    cell = F.floor(F.col("before") * F.lit(1 << bits) / F.col("rows")).cast("int")
    return placed.join(F.broadcast(rows)).select("value", cell.alias("cell"))


def hilbert_order(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Add ``curve_index`` to ``df``; its other columns are kept.

    The curve is a table of 2 ** (bits * dimensions) rows, at most 2 ** 16. A dimension's cells are a table of its
    distinct values.
    """
    if bits * len(dimensions) > 16:
        raise ValueError("the curve's table would have more than 65,536 rows")
    spark, point = df.sparkSession, F.lit(0)
    for i, column in enumerate(dimensions):
        cut = write_table(cells(df, column, bits), "cells").withColumnRenamed("value", f"value_{i}").withColumnRenamed("cell", f"cell_{i}")
        df = df.join(cut, df[column].eqNullSafe(cut[f"value_{i}"])).drop(f"value_{i}")
        point = F.shiftleft(point, bits).bitwiseOR(F.col(f"cell_{i}"))
    table = spark.createDataFrame(curve(len(dimensions), bits), "point int, curve_index int")
    return df.withColumn("point", point).join(F.broadcast(table), "point").drop("point", *[f"cell_{i}" for i in range(len(dimensions))])


def assign_shards(df: DataFrame, dimensions: list[str], shards: int = SHARDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: id, the dimensions, size, text_crc32, curve_index, shard, slot.

    size is the text's UTF-8 bytes plus 1 (null: 1). A row belongs to the shard in which the middle of its bytes falls
    when the order is cut into ``shards`` equal parts, so sizes differ by at most one document. The order is by curve
    index, then hash of the text (equal texts of a cell lie together), then id; slot is the place in the shard, from 0
    without gaps. A null dimension is a value of its own, below all others; a null id comes first. Rows that are equal
    in all this come in any order. An empty table gives no rows. Other columns are not read.
    """
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    narrow = df.select(
        F.col(id).alias("row_id"),
        *[F.col(c).alias(f"dim_{i}") for i, c in enumerate(dimensions)],
        size.alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    narrow = write_table(narrow, "narrow")
    ordered = hilbert_order(narrow, [f"dim_{i}" for i in range(len(dimensions))])
    placed = running_total(ordered.select("curve_index", "text_crc32", "row_id", "size", *[f"dim_{i}" for i in range(len(dimensions))]), ["curve_index", "text_crc32", "row_id"], "size")
    placed = write_table(placed, "placed")
    whole = placed.agg(F.sum("size").alias("whole"))
    middle = F.floor((F.col("before") * 2 + F.col("size")) * F.lit(shards) / (F.col("whole") * 2))
    cut = placed.join(F.broadcast(whole)).withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
    firsts = cut.groupBy("shard").agg(F.min("position").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        F.col("row_id").alias(id),
        *[F.col(f"dim_{i}").alias(c) for i, c in enumerate(dimensions)],
        "size",
        "text_crc32",
        "curve_index",
        "shard",
        (F.col("position") - F.col("first")).cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, shards: DataFrame, id: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """Write the rows of ``df`` below ``path``, one folder for each shard, files in slot order.

    ``shards`` is what ``assign_shards`` gave for ``df``, whose ids must be unique. A shard is written by several tasks
    that each take a run of its slots.
    """
    keyed = df.join(shards.select(id, "shard", "slot"), id)
    run = F.floor(F.col("slot") / rows_per_file)
    keyed.withColumn("run", run).repartition("shard", "run").sortWithinPartitions("shard", "slot").drop("run").write.partitionBy("shard").parquet(path)
