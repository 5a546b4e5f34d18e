"""Live fleet picture from telemetry in arrival order: latest state per ship, status changes, mission outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wakeline import catalogue as C
from wakeline.functions.text import ship_or_unknown, status_colour, status_marker
from wakeline.operators.arrival import CHUNK, first_per_key, latest_per_key, with_previous


def is_terminal() -> Column:
    return F.coalesce(F.col("mission_status").isin(*C.TERMINAL_STATES), F.lit(False))


def named_ships(telemetry: DataFrame) -> DataFrame:
    """Events with a ship to show: one without a ship id counts as UNKNOWN, a row with neither ship nor mission (what an
    unreadable record leaves) as none."""
    seen = telemetry
    if "mission_id" in telemetry.columns:
        seen = telemetry.where(F.coalesce(F.col("ship_id").cast("string"), F.col("mission_id").cast("string")).isNotNull())
    return seen.withColumn("ship_id", ship_or_unknown(F.col("ship_id")))


def drop_finished(latest: DataFrame) -> DataFrame:
    """Ships whose latest event does not end their mission, with their dot colour."""
    return latest.where(~is_terminal()).withColumn("colour", status_colour(F.col("status")))


def radar_latest(telemetry: DataFrame, order: str = "seq") -> DataFrame:
    """Latest event per ship. Terminal events are dropped after the latest is chosen: a ship that reports again
    after its mission ended is back on the radar, one that does not is gone."""
    return drop_finished(latest_per_key(named_ships(telemetry), ["ship_id"], order))


def active_count(radar: DataFrame) -> DataFrame:
    return radar.agg(F.count(F.lit(1)).alias("vessels"))


def remembered_status() -> Column:
    """Status a ship is known by after an event; a terminal event clears it."""
    return F.when(~is_terminal(), F.coalesce(F.col("status"), F.lit(C.OK)))


def radar_transitions(
    telemetry: DataFrame, order: str = "seq", chunk: int = CHUNK, carried: DataFrame | None = None
) -> DataFrame:
    """``ship_id, seq, previous, current, marker`` for every event that changes a ship's known status.

    What is known before an event is exactly the status of the ship's event before it, so one step back suffices.
    """
    events = named_ships(telemetry).select("ship_id", F.col(order).alias("seq"), "status", "mission_status")
    steps = with_previous(events, "ship_id", "seq", remembered_status(), chunk, carried)
    changed = F.col("current").isNotNull() & ~F.col("current").eqNullSafe(F.col("previous"))
    return steps.where(changed).select("ship_id", "seq", "previous", "current", status_marker(F.col("current")).alias("marker"))


def last_known(telemetry: DataFrame, order: str = "seq") -> DataFrame:
    """``ship_id, state`` after the given events; null where cleared."""
    events = named_ships(telemetry).select("ship_id", order, remembered_status().alias("state"))
    return latest_per_key(events, ["ship_id"], order).select("ship_id", "state")


def mission_outcomes(telemetry: DataFrame, order: str = "seq") -> DataFrame:
    """First terminal event per mission: ``mission_id, status, ended_at`` (event time text) and its arrival number."""
    ends = telemetry.where(is_terminal()).select(
        "mission_id", F.col(order).alias("seq"), F.col("mission_status").alias("status"), F.col("timestamp").alias("ended_at")
    )
    return first_per_key(ends, ["mission_id"], "seq")
