"""The two fixed dimensions: destinations and cargo prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline import catalogue as C
from wakeline.functions.numeric import arrived


def planets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.PLANETS), "planet string, x double, y double, z double")


def cargo_items(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.CARGO_ITEMS), "item string, value int")


def with_target_position(df: DataFrame, places: DataFrame, target: str = "target") -> DataFrame:
    """Add ``target_x/y/z`` of the destination; null for an unknown one. ``places`` is a fixed dimension of 21 rows."""
    named = places.select(
        F.col("planet").alias(target), *[F.col(a).alias(f"target_{a}") for a in ("x", "y", "z")]
    )
    return df.join(F.broadcast(named), target, "left")


def unknown_targets(df: DataFrame, places: DataFrame, target: str = "target") -> DataFrame:
    """Rows whose destination is not in the dimension."""
    return df.join(F.broadcast(places.select(F.col("planet").alias(target))), target, "left_anti")


def with_arrival(df: DataFrame, speed: float = C.CRUISE_SPEED, rtol: float = C.ARRIVAL_RTOL) -> DataFrame:
    """Add ``arrived``: every axis within one tick's travel of the target."""
    x, y, z = [arrived(F.col(f"coord_{a}"), F.col(f"target_{a}"), speed, rtol) for a in ("x", "y", "z")]
    return df.withColumn("arrived", x & y & z)
