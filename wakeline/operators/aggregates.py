"""Aggregates with the null and tie rules the summaries rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from wakeline.functions.numeric import ratio
from wakeline.session import stored


def count_where(condition: Column) -> Column:
    """Rows meeting ``condition``; 0 when none does."""
    return F.count_if(condition)


def sum_and_count(column: str, prefix: str) -> list[Column]:
    """Exact parts of an average, so that it can be merged across groups and divided once."""
    return [F.sum(column).alias(f"{prefix}_sum"), F.count(column).alias(f"{prefix}_n")]


#: Type of a sum of money before it is divided. A sum of sums is decimal(38,2), whose quotients Spark cuts to six digits;
#: from this type twelve remain.
MONEY = "decimal(28,2)"


def average(prefix: str) -> Column:
    """Average from the parts of ``sum_and_count``; null when no value was counted. Sums of ``value`` are money."""
    total = F.col(f"{prefix}_sum")
    return ratio(total.cast(MONEY) if prefix == "value" else total, F.col(f"{prefix}_n"))


def count_into(df: DataFrame, counter: Observation | None) -> DataFrame:
    """``df`` with its rows counted into ``counter`` (as ``rows``) while whatever action runs on it; no extra job."""
    return df if counter is None else df.observe(counter, F.count(F.lit(1)).alias("rows"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def top_per_group(counts: DataFrame, group: str, label: str, size: str) -> DataFrame:
    """Per group the label with the highest count; ties go to the alphabetically first label.

    ``counts`` has one row per (group, label). A struct minimum merges map-side, so a hot group needs no window.
    """
    best = F.min(F.struct((-F.col(size)).alias("negated"), F.col(label).alias("label"))).alias("_best")
    return (
        counts.groupBy(group)
        .agg(best)
        .select(group, F.col("_best.label").alias(label), (-F.col("_best.negated")).alias(size))
    )


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Number all rows 1..n by ``order``, which must be without ties, as a column.

    Rows are dealt into ranges of the order and stored with the number of their range; a window numbers a range, and what
    is added up in one task is a count a range.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_inside", inside).join(sizes, "_range").select((F.col("_before") + F.col("_inside")).alias(name), *df.columns)


def favourite_ship(missions: DataFrame) -> DataFrame:
    """Most flown ship per captain and how often: ``captain, favorite_ship, nb_fav_ship_missions``."""
    counts = missions.groupBy("captain", F.col("ship_name").alias("favorite_ship")).agg(
        F.count(F.lit(1)).alias("nb_fav_ship_missions")
    )
    return top_per_group(counts, "captain", "favorite_ship", "nb_fav_ship_missions")
