"""Session settings the library expects; a cluster passes its own session instead."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "swathbook", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UTC, AQE on, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
