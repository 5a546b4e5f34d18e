"""Exact distinct counts that merge: a bitmap per key and block of 32,768 numbers, built once a period and joined later.

Values are small whole numbers (``numbered`` makes them of names). A period's rows are read once; any span of periods is
counted from its bitmaps alone. Partials merge map-side and are of fixed size, so a key with a third of all rows costs one
bitmap a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def numbered(names: DataFrame, name: str, known: DataFrame | None = None) -> DataFrame:
    """``name, number`` of all names: those of ``known`` keep theirs, new ones follow in order. For dimensions: the names
    of one run's news are ordered in one task."""
    new = names.select(name).where(F.col(name).isNotNull()).distinct()
    if known is None:
        return new.withColumn("number", F.row_number().over(Window.orderBy(name)).cast("bigint"))
    new = new.join(known.select(name), name, "left_anti")
    after = known.select(F.coalesce(F.max("number"), F.lit(0))).scalar()
    new = new.withColumn("number", (F.row_number().over(Window.orderBy(name)) + after).cast("bigint"))
    return known.select(name, "number").unionByName(new)


def distinct_partials(rows: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """``keys, block, bitmap`` of the numbers seen with each key; null numbers are none."""
    rows = rows.where(number.isNotNull()).withColumns({"block": F.bitmap_bucket_number(number), "_bit": F.bitmap_bit_position(number)})
    return rows.groupBy(*keys, "block").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merged_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials by fewer ``keys``: what periods share counts once."""
    return partials.groupBy(*keys, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(partials: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """``keys`` with their number of distinct values over all partials given."""
    return merged_partials(partials, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))
