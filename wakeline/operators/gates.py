"""Freshness gates: one row saying whether a refresh has anything to do. The caller decides what to do with it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from wakeline.functions.times import before

MISSION_WINDOW = timedelta(minutes=30)
MANIFEST_WINDOW = timedelta(minutes=15)


def freshness_gate(df: DataFrame, column: str, as_of: datetime | str, window: timedelta) -> DataFrame:
    """``should_run`` and ``n``, the number of rows newer than ``as_of - window``."""
    recent = df.where(F.col(column) > before(as_of, window))
    return recent.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") > 0).alias("should_run"), "n")


def missions_gate(missions: DataFrame, as_of: datetime | str, window: timedelta = MISSION_WINDOW) -> DataFrame:
    return freshness_gate(missions, "updated_at", as_of, window)


def manifests_gate(manifests: DataFrame, as_of: datetime | str, window: timedelta = MANIFEST_WINDOW) -> DataFrame:
    return freshness_gate(manifests, "upload_time", as_of, window)
