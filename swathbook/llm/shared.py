"""Tables that all executors see: lineage is cut by writing them to the folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_folders: dict[str, str] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to all executors (once a session): their Python functions import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="swathbook-code-"), "swathbook.zip")
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                packed.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this run below ``spark.checkpoint.dir``; where that is unset (tests), a local one."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="swathbook-")
        _folders[app] = f"{base.rstrip('/')}/swathbook-{uuid.uuid4().hex}"
        atexit.register(remove_tables, spark, _folders[app])
    return _folders[app]


def remove_tables(spark: SparkSession, folder: str) -> None:
    """Delete a folder of shared tables, or one table; used when the program ends or a table is not needed any more."""
    if spark.sparkContext._jsc is None:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back with its schema (also when it is empty)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)
    table.table_path = path
    return table


def drop_tables(*tables: DataFrame | None) -> None:
    """Delete tables made by ``write_table`` that nothing will read any more (None and other DataFrames are passed over)."""
    for table in tables:
        path = vars(table).get("table_path") if table is not None else None
        if path:
            remove_tables(table.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are written and not referred to any more."""
    gc.collect()
    spark._jvm.System.gc()


def trim_memory() -> None:
    """Give back to the system what this process has freed; a Python worker otherwise keeps it while it waits for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def shuffles_for(spark: SparkSession, rows: int, rows_per_task: int = 50_000) -> Iterator[None]:
    """Shuffle partitions for about ``rows`` narrow rows, at most as many as the session has; for work that runs inside."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(1, min(int(before), -(-rows // rows_per_task)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def running_total(df: DataFrame, order: list[str], value: str, partitions: int | None = None) -> DataFrame:
    """Add ``before`` (sum of ``value`` over all earlier rows) and ``position`` (number of earlier rows).

    Rows are range-partitioned by ``order``, so a partition's running sum only needs the sum of the partitions before
    it. The sorted rows are written once: both readings see the same partitions. ``order`` should make rows unique,
    else tied rows come in any order. The window that runs over one task has one row for each partition.
    """
    from pyspark.sql import Window as W

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = df.select(*order, *[c for c in df.columns if c not in order])
    cut = kept.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    cut = write_table(cut, "sorted")
    sums = cut.groupBy("part").agg(F.sum(value).alias("part_sum"), F.count(F.lit(1)).alias("part_rows"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        "part",
        F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inner = W.partitionBy("part").orderBy(*order)
    upto = inner.rowsBetween(W.unboundedPreceding, 0)
    return (
        cut.withColumn("_upto", F.sum(value).over(upto))
        .withColumn("_row", F.row_number().over(inner))
        .join(F.broadcast(sums), "part")
        .withColumn("before", (F.col("sum_before") + F.col("_upto") - F.col(value)).cast("long"))
        .withColumn("position", (F.col("rows_before") + F.col("_row") - 1).cast("long"))
        .drop("part", "sum_before", "rows_before", "_upto", "_row")
    )
