"""Mission registry: registrations, completions and the ``updated_at`` rule."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wakeline import catalogue as C
from wakeline.functions.text import normal_status
from wakeline.functions.times import instant
from wakeline.operators.arrival import CHUNK, latest_per_key, number_by_arrival
from wakeline.schemas import MISSIONS, land


def register(missions: DataFrame, requests: DataFrame, as_of: datetime | str, chunk: int = CHUNK) -> DataFrame:
    """Missions plus one RUNNING mission per request.

    ``requests``: ``request_id`` (arrival number), ``ship_name, captain, target, report_freq_min``. Ids follow the
    highest id in use, dense and in arrival order.
    """
    last_id = missions.select(F.coalesce(F.max("mission_id"), F.lit(0))).scalar()
    new = number_by_arrival(requests, "request_id", "_number", chunk).select(
        (last_id + F.col("_number")).alias("mission_id"),
        "ship_name",
        "captain",
        "target",
        "report_freq_min",
        F.lit(C.RUNNING).alias("status"),
        instant(as_of).alias("started_at"),
        F.lit(None).alias("finished_at"),
        instant(as_of).alias("updated_at"),
    )
    return missions.select(*MISSIONS.names).unionByName(land(new, MISSIONS))


def complete(missions: DataFrame, commands: DataFrame, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """Missions with completions applied, and the commands' ids that match no mission.

    ``commands``: ``command_id`` (arrival number), ``mission_id, status``; the last command per mission wins.
    """
    last = latest_per_key(commands.select("mission_id", "command_id", "status"), ["mission_id"], "command_id").select(
        "mission_id", normal_status(F.col("status")).alias("_status"), F.lit(True).alias("_hit")
    )
    now = instant(as_of)

    def changed(value, column):
        return F.when(F.col("_hit"), value).otherwise(F.col(column)).alias(column)

    done = missions.join(last, "mission_id", "left").select(
        "mission_id",
        "ship_name",
        "captain",
        "target",
        "report_freq_min",
        changed(F.col("_status"), "status"),
        "started_at",
        changed(now, "finished_at"),
        changed(now, "updated_at"),
    )
    return done, last.join(missions.select("mission_id"), "mission_id", "left_anti").select("mission_id")


def touch_parents(missions: DataFrame, children: DataFrame, loaded_at: str = "loaded_at") -> DataFrame:
    """Missions whose ``updated_at`` follows the newest load of a child row."""
    newest = children.groupBy("mission_id").agg(F.max(loaded_at).alias("_loaded"))
    moved = F.greatest(F.col("updated_at"), F.col("_loaded"))
    return missions.join(newest, "mission_id", "left").withColumn("updated_at", moved).drop("_loaded")
