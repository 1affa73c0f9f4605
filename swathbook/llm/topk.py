"""Exact top-k search by inner product, over vectors in descending order of length.

Vectors are turned by the singular vectors of the whole table, so that a few components hold most of a vector's
length. They are sorted by length and cut into blocks. Queries, also in blocks, first meet the blocks of the longest
vectors, which gives each query a lower bound for its k-th score. After that a block is skipped if the longest vector
in it cannot reach the bound (Cauchy-Schwarz); inside a block the partial sum over the leading components plus the
product of the remaining lengths bounds each score; only what can reach the bound gets its exact integer score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package, write_table

#: Vectors in a block, and queries in a block.
BLOCK, QUERY_BLOCK = 2048, 256
#: Leading blocks that give the queries their first bound.
SEED_BLOCKS = 1


def quantise(vector: str, factor: float = 256.0):
    """floor(factor * x) of each component, as bigint; null for a null vector or one with a null, NaN or infinite component."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("bigint")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column; a shorter vector is filled up with zeros."""
    rows = len(column)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(rows, dims)
    out = np.zeros((rows, dims), np.int64)
    which = np.repeat(np.arange(rows), lengths)
    out[which, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _gram(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["cell", "value"])

    return run


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, by descending singular value; sums of products are made by Spark."""
    sums = vectors.select("v").mapInArrow(_gram(dims), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    gram = np.zeros(dims * dims)
    gram[sums["cell"].to_numpy()] = sums["value"].to_numpy()
    values, axes = np.linalg.eigh(gram.reshape(dims, dims))
    return axes[:, np.argsort(-values, kind="stable")]


def _pack(dims: int, size: int, with_norm: bool):
    """Blocks of rows in the order they come: ids and components as bytes, largest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, filled = [], [], 0

        def block(ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            norm = float(np.sqrt((v.astype(np.float64) ** 2).sum(1)).max())
            return pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "body": [v.tobytes()], "norm": [norm]})

        for batch in batches:
            ids.append(batch.column("id").to_numpy(zero_copy_only=False))
            rows.append(_matrix(batch.column("v"), dims))
            filled += len(batch)
            while filled >= size:
                all_ids, all_rows = np.concatenate(ids), np.concatenate(rows)
                yield block(all_ids[:size], all_rows[:size])
                ids, rows, filled = [all_ids[size:]], [all_rows[size:]], filled - size
        if filled:
            yield block(np.concatenate(ids), np.concatenate(rows))

    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(q_ids, q, bound, ids, x, axes, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best of a block for each query, those that can reach the query's bound (-inf: all)."""
    lead = max(1, min(axes.shape[1], 16))
    turned, asked = x @ axes, q @ axes
    rest_x = np.sqrt((turned[:, lead:] ** 2).sum(1))
    rest_q = np.sqrt((asked[:, lead:] ** 2).sum(1))
    length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    own = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    out = []
    for i in range(len(q)):
        slack = 1e-9 * (1 + own[i] * (length[0] if len(length) else 0))
        reach = np.searchsorted(-length, -((bound[i] - slack) / own[i]), "right") if own[i] > 0 and np.isfinite(bound[i]) else len(x)
        if own[i] == 0 and bound[i] > 0:
            continue
        top = turned[:reach, :lead] @ asked[i, :lead] + rest_x[:reach] * rest_q[i]
        may = np.flatnonzero((top >= bound[i] - slack) & (ids[:reach] != q_ids[i]))
        scores = x[may] @ q[i]
        for j in _best(scores, ids[may], k):
            out.append((int(q_ids[i]), int(ids[may[j]]), int(scores[j])))
    return out


def _search(dims: int, shared, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                ids = np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q_body"], np.int64).reshape(len(q_ids), dims)
                x = np.frombuffer(row["body"], np.int64).reshape(len(ids), dims)
                bound = np.frombuffer(row["bound"], np.float64) if row["bound"] is not None else np.full(len(q_ids), -np.inf)
                found = search_block(q_ids, q, bound, ids, x, axes, k)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 3, schema=schema)

    return run


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "v") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of ``queries`` its ``k`` largest inner products over ``df``.

    ``vector`` holds integers (bigint) whose products' sums stay below 2 ** 53. A row does not find itself (rows of
    the same id); ties go to the smaller id. Fewer than ``k`` other vectors give as many rows. Rows whose id or
    vector is null take no part; a vector shorter than the longest one counts as filled up with zeros, an empty one as
    zero. A row that is repeated is found as often as it occurs, a repeated query is asked once. Empty tables
    give no rows. Other columns are not read.
    """
    spark = df.sparkSession
    ship_package(spark)
    held = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    held = write_table(held.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))), "vectors")
    asked = queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null").dropDuplicates(["id"])
    row = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims = max(int(row["dims"] or 0), int(asked.agg(F.max(F.size("v"))).first()[0] or 0), 1)
    axes = spark.sparkContext.broadcast(rotation(held, dims))
    parts = max(1, -(-row["n"] // (BLOCK * 4)))
    longest = held.repartitionByRange(parts, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id").select("id", "v")
    packed = longest.mapInArrow(_pack(dims, BLOCK, True), "ids binary, body binary, norm double")
    blocks = write_table(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    order = W.orderBy("block")  # one row for each block, without its vectors
    numbered = blocks.select("block", "norm").withColumn("b", F.row_number().over(order) - 1)
    numbers = write_table(numbered, "numbers")
    count = numbers.count()
    blocks = blocks.join(numbers.select("block", "b"), "block").select("b", "ids", "body", "norm")
    queries_in = asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK)), "id").sortWithinPartitions("id").select("id", "v")
    asks = queries_in.mapInArrow(_pack(dims, QUERY_BLOCK, False), "ids binary, body binary, norm double")
    asks = asks.select(F.col("ids").alias("q_ids"), F.col("body").alias("q_body"), F.col("norm").alias("q_norm"))
    asks = write_table(asks.withColumn("q", F.monotonically_increasing_id()), "asks")

    def found(pairs: DataFrame) -> DataFrame:
        return pairs.select("q_ids", "q_body", "ids", "body", "bound").mapInArrow(_search(dims, axes, k), "query_id long, vec_id long, score long")

    none = F.lit(None).cast("binary")
    first = asks.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(min(SEED_BLOCKS, max(count, 1)) - 1))))
    seeds = write_table(found(first.join(blocks, "b").withColumn("bound", none)), "seeds")
    if count <= SEED_BLOCKS:
        return _ranked(seeds, k)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    least = seeds.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("bound"))

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["q_ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["q"])), pa.array(np.arange(len(ids))), pa.array(ids)], ["q", "at", "query_id"])

    members = asks.select("q", "q_ids").mapInArrow(unpacked, "q long, at long, query_id long")
    bounds = members.join(least, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    gathered = bounds.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("at", "bound"))).alias("each"), F.min("bound").alias("lowest"))
    as_bytes = F.arrow_udf(_as_bytes, "binary")(F.col("each.bound"))
    bounded = asks.join(gathered.select("q", as_bytes.alias("bound"), "lowest"), "q")
    wide = bounded.select("q", "q_norm", "lowest", F.explode(F.sequence(F.lit(SEED_BLOCKS), F.lit(count - 1))).alias("b"))
    wide = wide.join(numbers.select("b", "norm"), "b").where("q_norm * norm * (1 + 1e-9) >= lowest").select("q", "b")
    pairs = wide.join(blocks, "b").join(bounded, "q")
    return _ranked(seeds.unionByName(found(pairs)), k)


def _as_bytes(each: pa.Array) -> pa.Array:
    return pa.array([np.array(x, np.float64).tobytes() for x in each.to_pylist()], pa.binary())


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
