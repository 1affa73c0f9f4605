"""Equi-joins that stay balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a single task may take before the key is split.
ROWS_PER_SLOT = 1_000_000
#: Pairs of rows with one key that a single task may compare before the key is split.
PAIRS_PER_SLOT = 100_000_000
#: Rows up to which a measured side is broadcast.
BROADCAST_ROWS = 500_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measure whether ``df`` has at most ``max_rows`` rows (stops counting there)."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def split_keys(df: DataFrame, keys: list[str], rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Keys with more than ``rows_per_slot`` rows and the number of slots they need.

    There are at most rows / rows_per_slot such keys, which bounds what the join broadcasts.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > rows_per_slot).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], F.ceil(F.col("_rows") / rows_per_slot).cast("int").alias("_slots")
    )


def _with_slots(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    matches = [df[k] == hot[f"_hot_{k}"] for k in keys]
    joined = df.join(F.broadcast(hot), matches, "left")
    return joined.drop(*[f"_hot_{k}" for k in keys]).withColumn("_slots", F.coalesce("_slots", F.lit(1)))


def skew_join(
    big: DataFrame,
    other: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_slot: int = ROWS_PER_SLOT,
    condition: Column | None = None,
    row_id: list[str] | None = None,
) -> DataFrame:
    """Join on ``keys`` (inner or left) with the hot keys of ``big`` spread over several tasks.

    Hot keys are found by a pre-aggregated count. Their rows are dealt to slots
    by a hash of the row (``row_id``, default: all columns), and the rows of
    ``other`` with such a key are repeated once per slot. Key columns appear once
    in the result, other columns of the two sides must differ in name.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    hot = split_keys(big, keys, rows_per_slot)
    identity = [F.col(c) for c in (row_id or big.columns)]
    left = _with_slots(big, hot, keys).withColumn("_slot", F.pmod(F.xxhash64(*identity), F.col("_slots")).cast("int"))
    right = _with_slots(other, hot, keys).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    right = right.drop("_slots").select(
        *[F.col(c).alias(f"_key_{c}") if c in keys + ["_slot"] else F.col(c) for c in right.drop("_slots").columns]
    )
    on = F.lit(True)
    for k in keys + ["_slot"]:
        on = on & (left[k] == right[f"_key_{k}"])
    if condition is not None:
        on = on & condition
    return left.join(right, on, how).drop("_slots", "_slot", *[f"_key_{k}" for k in keys + ["_slot"]])


def grid_join(
    big: DataFrame,
    other: DataFrame,
    keys: list[str],
    rows_per_slot: int = ROWS_PER_SLOT,
    pairs_per_slot: int = PAIRS_PER_SLOT,
    condition: Column | None = None,
    big_id: list[str] | None = None,
    other_id: list[str] | None = None,
) -> DataFrame:
    """Inner join whose hot keys become a grid of slots: cut on both sides, by rows and by pairs of rows.

    Both sides are counted by key first. A key with more than ``rows_per_slot`` rows on a side is cut on that side, and
    ``big`` further until a slot compares about ``pairs_per_slot`` pairs. At most as many keys are cut as the rows of
    both sides / ``rows_per_slot`` and sqrt(rows x rows / ``pairs_per_slot``) make, which bounds the broadcast. Rows
    are dealt by a hash of ``big_id`` and ``other_id`` (default: all columns).
    """
    n_big = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_big"))
    n_other = other.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_other"))
    across, down = F.ceil(F.col("_n_big") / rows_per_slot), F.ceil(F.col("_n_other") / rows_per_slot)
    pairs = F.col("_n_big").cast("double") * F.col("_n_other")
    across = F.least(F.col("_n_big"), across * F.ceil(pairs / (across * down * float(pairs_per_slot))))
    hot = (
        n_big.join(n_other, keys)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], across.cast("int").alias("_across"), down.cast("int").alias("_down"))
        .filter("_across > 1 OR _down > 1")
    )

    def dealt(df: DataFrame, own: str, repeated: str, identity: list[str] | None) -> DataFrame:
        joined = df.join(F.broadcast(hot), [df[k] == hot[f"_hot_{k}"] for k in keys], "left")
        slot = F.pmod(F.xxhash64(*(identity or df.columns)), F.coalesce(own, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(repeated, F.lit(1)) - 1))
        return joined.select(*[df[c] for c in df.columns], slot.alias(f"_slot{own}"), every.alias(f"_slot{repeated}"))

    left = dealt(big, "_across", "_down", big_id)
    right = dealt(other, "_down", "_across", other_id)
    on_names = [*keys, "_slot_across", "_slot_down"]
    right = right.select(*[F.col(c).alias(f"_key_{c}") if c in on_names else F.col(c) for c in right.columns])
    on = F.lit(True)
    for k in on_names:
        on = on & (left[k] == right[f"_key_{k}"])
    if condition is not None:
        on = on & condition
    return left.join(right, on, "inner").drop("_slot_across", "_slot_down", *[f"_key_{k}" for k in on_names])
