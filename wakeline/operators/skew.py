"""Spreading hot keys. A key that holds a third of all rows is cut into slices of bounded size; results stay whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROWS_PER_SLICE = 1_000_000
#: Longest list of hot keys; it bounds the broadcasts below. A key that is not among the hottest holds less than
#: rows / MOST_HOT rows.
MOST_HOT = 10_000


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``key, n``: rows of each key, null included."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(df: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE, counts: DataFrame | None = None) -> DataFrame:
    """``key, _slices`` for the ``MOST_HOT`` hottest keys above ``rows_per_slice`` rows.

    ``counts`` (key, n) of ``df``, where the caller has them, save the scan that counts.
    """
    known = key_counts(df, key) if counts is None else counts.select(key, "n")
    hottest = known.where(F.col("n") > rows_per_slice).orderBy(F.desc("n"), key).limit(MOST_HOT)
    return hottest.select(key, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("_slices"))


def with_slice(
    df: DataFrame, key: str, spread_by: Column, rows_per_slice: int = ROWS_PER_SLICE, counts: DataFrame | None = None
) -> DataFrame:
    """Add ``_slice``: 0 for ordinary keys, for hot ones a hash of ``spread_by`` and the input partition over the key's
    slices.

    The partition number spreads equal rows too. A retried task reads the same partition, so it puts its rows where the
    lost one did; nothing here is random. Null is a key like any other.
    """
    hot = F.broadcast(hot_keys(df, key, rows_per_slice, counts).withColumnRenamed(key, "_hot"))
    slice_no = F.coalesce(F.pmod(F.xxhash64(spread_by, F.spark_partition_id()), F.col("_slices")), F.lit(0)).cast("int")
    marked = df.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left")
    return marked.withColumn("_slice", slice_no).drop("_hot", "_slices")


def sliced_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: Column,
    rows_per_slice: int = ROWS_PER_SLICE,
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Inner, left_semi or left_anti join of a large side with a side unique in ``key``: rows of hot keys meet copies
    of their small row. ``counts`` (key, n) of the large side, where known (best a stored table), save two scans of it.

    Unlike the runtime skew join it also works where the result is grouped by ``key`` right after, and in micro-batches.
    """
    if how != "left_anti":
        large = large.where(F.col(key).isNotNull())
    hot = F.broadcast(hot_keys(large, key, rows_per_slice, counts))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    copied = small.join(hot, key, "left").withColumn("_slice", copies).drop("_slices")
    return with_slice(large, key, spread_by, rows_per_slice, counts).join(copied, [key, "_slice"], how).drop("_slice")


def spread_for_write(df: DataFrame, key: str, spread_by: Column, rows_per_file: int = ROWS_PER_SLICE) -> DataFrame:
    """Hash-partition by key for a partitioned write: one file per ordinary key, several for a hot one."""
    return with_slice(df, key, spread_by, rows_per_file).repartition(key, "_slice").drop("_slice")
