"""Operators that depend on arrival order, written so that one hot key never has to fit in one task.

``order`` is a unique ascending arrival number (a topic offset, an event id). Arrival numbers are cut into chunks of
fixed width, so whatever share of the rows a key holds, a (key, chunk) group has at most ``chunk`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 1_000_000


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the highest ``order`` per key. Partial aggregation leaves one row per key and map task to shuffle."""
    return _pick(df, keys, F.max_by, order)


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the lowest ``order`` per key."""
    return _pick(df, keys, F.min_by, order)


def _pick(df: DataFrame, keys: list[str], pick, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_row")).select(*keys, "_row.*")


def with_previous(
    df: DataFrame,
    key: str,
    order: str,
    state: Column,
    chunk: int = CHUNK,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Add ``current`` (``state`` of the row) and ``previous`` (``state`` of the key's row before it).

    The state that enters a chunk is found from one aggregated row per (key, chunk) and joins the chunk as a marker
    row, so the window partitions by (key, chunk) instead of by key alone. ``carried`` (key, state) supplies what was
    known before the first row, e.g. from an earlier micro-batch.
    """
    rows = df.withColumns({"_chunk": F.floor(F.col(order) / chunk).cast("bigint"), "current": state})
    leaving = rows.groupBy(key, "_chunk").agg(F.max_by("current", order).alias("current"))
    if carried is not None:
        before = F.lit(-(2**62)).cast("bigint").alias("_chunk")
        leaving = leaving.unionByName(carried.select(key, before, F.col("state").alias("current")))
    entering = (
        leaving.withColumn("current", F.lag("current").over(Window.partitionBy(key).orderBy("_chunk")))
        .where(F.col("current").isNotNull())
        .select(key, "_chunk", (F.col("_chunk") * chunk - 1).alias(order), "current", F.lit(True).alias("_marker"))
    )
    ordered = Window.partitionBy(key, "_chunk").orderBy(order)
    return (
        rows.withColumn("_marker", F.lit(False))
        .unionByName(entering, allowMissingColumns=True)
        .withColumn("previous", F.lag("current").over(ordered))
        .where(~F.col("_marker"))
        .drop("_marker", "_chunk")
    )


def number_by_arrival(df: DataFrame, order: str, name: str = "number", chunk: int = CHUNK) -> DataFrame:
    """Number the rows 1..n without gaps in arrival order.

    Rows are numbered inside their chunk and shifted by the count of all earlier chunks, which is added up over blocks of
    2^16 chunks and blocks of 2^16 such blocks. However far apart arrival numbers lie, no task orders more than 2^16
    of these counts (of the outermost, that is all there can be for chunks of a million).
    """
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk).cast("bigint"))
    counts = rows.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumns({"_block": F.shiftright("_chunk", 16), "_outer": F.shiftright("_chunk", 32)})
    blocks = counts.groupBy("_outer", "_block").agg(F.sum("_n").alias("_n"))
    outer = blocks.groupBy("_outer").agg(F.sum("_n").alias("_n"))

    def earlier(by: str, inside: str | None) -> Column:
        window = Window.partitionBy(inside) if inside else Window
        return F.coalesce(F.sum("_n").over(window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    outer = outer.select("_outer", earlier("_outer", None).alias("_shift_outer"))
    blocks = blocks.select("_outer", "_block", earlier("_block", "_outer").alias("_shift_block"))
    shift = counts.select("_outer", "_block", "_chunk", earlier("_chunk", "_block").alias("_shift_chunk"))
    shift = shift.join(blocks, ["_outer", "_block"]).join(outer, "_outer")
    shift = shift.select("_chunk", (F.col("_shift_chunk") + F.col("_shift_block") + F.col("_shift_outer")).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(order))
    return rows.join(shift, "_chunk").withColumn(name, (F.col("_shift") + inside).cast("bigint")).drop("_chunk", "_shift")
