"""Business layer: one summary per mission (operations, cargo, manifests) and one per destination.

Child tables are aggregated by ``mission_id`` alone before they meet the missions. That keeps map-side merging, so a
mission holding a third of all ticks costs one partial row per task, and every join is one row to one row.
"""

from __future__ import annotations

from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from wakeline import catalogue as C
from wakeline.functions.numeric import count_ratio, round_numeric
from wakeline.functions.times import duration_hours, epoch, instant
from wakeline.operators.aggregates import average, count_where, sum_and_count
from wakeline.operators.upsert import upsert

# What a refresh overwrites on a known key. Status, finish, duration, ticks, radiation and cargo integrity
# of a mission keep the values of its first summary.
MISSION_UPDATE_COLS = ("avg_health", "uptime_ratio", "min_fuel_prc", "max_temp_c", "computed_at")
CARGO_UPDATE_COLS = ("nb_unique_items", "total_value_poko", "avg_value", "max_item_value", "computed_at")
MANIFEST_UPDATE_COLS = ("nb_manifests", "last_upload_time", "last_status", "computed_at")
PLANET_UPDATE_COLS = (
    "nb_missions",
    "nb_success",
    "nb_failure",
    "success_rate_pct",
    "avg_health",
    "avg_uptime_pct",
    "avg_value_poko",
    "computed_at",
)
DESCRIPTION = ("ship_name", "captain", "target")


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def mission_summary(missions: DataFrame, ship_state: DataFrame, as_of: datetime | str) -> DataFrame:
    """Operational KPIs per mission. A mission without ticks has uptime 0, not null, and null averages."""
    ticks = ship_state.groupBy("mission_id").agg(
        F.count("timestamp").alias("ticks"),
        F.count(F.lit(1)).alias("rows"),
        count_where(F.col("ship_condition") == "GOOD").alias("good"),
        F.min("fuel_prc").alias("min_fuel_prc"),
        F.max("temperature_C").alias("max_temp_c"),
        *sum_and_count("normalized_health_total", "health"),
        *sum_and_count("radiation_uSv", "radiation"),
        *sum_and_count("cargo_integrity_prc", "integrity"),
    )
    rows = F.greatest(_count("rows"), F.lit(1))
    return missions.join(ticks, "mission_id", "left").select(
        "mission_id",
        *DESCRIPTION,
        "report_freq_min",
        "status",
        "started_at",
        "finished_at",
        duration_hours(F.col("started_at"), F.col("finished_at"), as_of).alias("mission_duration_hr"),
        _count("ticks").alias("total_ticks"),
        average("health").alias("avg_health"),
        "min_fuel_prc",
        "max_temp_c",
        average("radiation").alias("avg_radiation_usv"),
        average("integrity").alias("avg_cargo_int_prc"),
        count_ratio(_count("good"), rows).alias("uptime_ratio"),
        instant(as_of).alias("computed_at"),
    )


def cargo_summary(missions: DataFrame, mission_reports: DataFrame, as_of: datetime | str) -> DataFrame:
    """Cargo value per mission; sums are null without reports.

    The first aggregation is by (mission, item): it removes repeats of an item and spreads a hot mission over its
    items; the second counts and adds up what is left.
    """
    items = mission_reports.groupBy("mission_id", "item").agg(
        *sum_and_count("value", "value"), F.max("value").alias("max_value")
    )
    cargo = items.groupBy("mission_id").agg(
        F.count("item").alias("items"),
        F.sum("value_sum").alias("value_sum"),
        F.sum("value_n").alias("value_n"),
        F.max("max_value").alias("max_item_value"),
    )
    return missions.join(cargo, "mission_id", "left").select(
        "mission_id",
        *DESCRIPTION,
        _count("items").alias("nb_unique_items"),
        F.col("value_sum").alias("total_value_poko"),
        average("value").alias("avg_value"),
        "max_item_value",
        instant(as_of).alias("computed_at"),
    )


def manifest_summary(missions: DataFrame, manifests: DataFrame, as_of: datetime | str) -> DataFrame:
    """Uploads per mission. ``last_status`` is the greatest status text, not the latest one.

    A maximum of text needs sorted input, so it is taken over one row per (mission, status), which a hash aggregate makes.
    """
    kinds = manifests.groupBy("mission_id", "status").agg(
        F.count("manifest_path").alias("uploads"), F.max("upload_time").alias("last_upload_time")
    )
    uploads = kinds.groupBy("mission_id").agg(
        F.sum("uploads").alias("uploads"),
        F.max("last_upload_time").alias("last_upload_time"),
        F.max("status").alias("last_status"),
    )
    return missions.join(uploads, "mission_id", "left").select(
        "mission_id",
        *DESCRIPTION,
        _count("uploads").alias("nb_manifests"),
        "last_upload_time",
        "last_status",
        instant(as_of).alias("computed_at"),
    )


def planet_summary(
    missions: DataFrame, missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str
) -> DataFrame:
    """KPIs per destination, with the missions' live status and the summaries' measures."""
    health = missions_bl.select("mission_id", "avg_health", "uptime_ratio")
    value = cargo_bl.select("mission_id", "total_value_poko")
    joined = missions.select("mission_id", "target", "status").join(health, "mission_id", "left").join(
        value, "mission_id", "left"
    )
    grouped = joined.groupBy(F.col("target").alias("planet")).agg(
        F.count("mission_id").alias("nb_missions"),
        F.count(F.lit(1)).alias("rows"),
        count_where(F.col("status") == C.SUCCESS).alias("nb_success"),
        count_where(F.col("status") == C.FAILURE).alias("nb_failure"),
        *sum_and_count("avg_health", "health"),
        *sum_and_count("uptime_ratio", "uptime"),
        *sum_and_count("total_value_poko", "value"),
    )
    return grouped.select(
        "planet",
        "nb_missions",
        "nb_success",
        "nb_failure",
        round_numeric(count_ratio(F.col("nb_success"), F.col("rows")) * 100, 1).alias("success_rate_pct"),
        round_numeric(average("health"), 3).alias("avg_health"),
        round_numeric(average("uptime") * 100, 1).alias("avg_uptime_pct"),
        round_numeric(average("value"), 0).alias("avg_value_poko"),
        instant(as_of).alias("computed_at"),
    )


def last_computed(target: DataFrame) -> Column:
    """Newest ``computed_at`` of a summary as a scalar subquery; the epoch for an empty one."""
    return target.select(F.coalesce(F.max("computed_at"), epoch())).scalar()


def changed_missions(missions: DataFrame, target: DataFrame) -> DataFrame:
    """Missions touched since the last mission summary, and all open ones."""
    return missions.where((F.col("updated_at") > last_computed(target)) | F.col("finished_at").isNull())


def cargo_due_missions(missions: DataFrame, target: DataFrame, as_of: datetime | str) -> DataFrame:
    """Missions finished since the last cargo summary, and all open ones while time moves on."""
    return missions.where(last_computed(target) < F.coalesce(F.col("finished_at"), instant(as_of)))


def refresh_mission_summary(
    target: DataFrame,
    missions: DataFrame,
    ship_state: DataFrame,
    as_of: datetime | str,
    update_cols: tuple[str, ...] | Literal["all"] = MISSION_UPDATE_COLS,
) -> DataFrame:
    """Summary after merging missions changed since the last run.

    By default a known mission keeps the status it was first summarised with; ``update_cols="all"`` refreshes it.
    """
    return upsert(target, mission_batch(target, missions, ship_state, as_of), ["mission_id"], update_cols)


def mission_batch(target: DataFrame, missions: DataFrame, ship_state: DataFrame, as_of: datetime | str) -> DataFrame:
    """New summary rows of the missions that changed."""
    return mission_summary(changed_missions(missions, target), ship_state, as_of)


def refresh_cargo_summary(
    target: DataFrame, missions: DataFrame, mission_reports: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Summary after merging due missions. Reports landing after a mission's last refresh are not picked up."""
    return upsert(target, cargo_batch(target, missions, mission_reports, as_of), ["mission_id"], CARGO_UPDATE_COLS)


def cargo_batch(target: DataFrame, missions: DataFrame, mission_reports: DataFrame, as_of: datetime | str) -> DataFrame:
    """New summary rows of the due missions."""
    return cargo_summary(cargo_due_missions(missions, target, as_of), mission_reports, as_of)


def refresh_manifest_summary(
    target: DataFrame, missions: DataFrame, manifests: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Summary after merging missions with an upload newer than the last run; others are never inserted."""
    return upsert(target, manifest_batch(target, missions, manifests, as_of), ["mission_id"], MANIFEST_UPDATE_COLS)


def manifest_batch(target: DataFrame, missions: DataFrame, manifests: DataFrame, as_of: datetime | str) -> DataFrame:
    """New summary rows of missions with an upload newer than the last run; only their manifests are aggregated."""
    fresh = manifests.where(F.col("upload_time") > last_computed(target)).select("mission_id").distinct()
    due = [df.join(fresh, "mission_id", "left_semi") for df in (missions, manifests)]
    return manifest_summary(*due, as_of)


def refresh_planet_summary(
    target: DataFrame, missions: DataFrame, missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Full recompute merged in; destinations without missions any more stay."""
    return upsert(target, planet_summary(missions, missions_bl, cargo_bl, as_of), ["planet"], PLANET_UPDATE_COLS)


def stale_statuses(missions_bl: DataFrame, missions: DataFrame) -> DataFrame:
    """Summarised missions whose stored status differs from the live one, counted per pair of states."""
    live = missions.select("mission_id", F.col("status").alias("live_status"))
    both = missions_bl.select("mission_id", F.col("status").alias("summary_status")).join(live, "mission_id")
    return (
        both.where("summary_status <> live_status")
        .groupBy("summary_status", "live_status")
        .agg(F.count(F.lit(1)).alias("nb_missions"))
    )
