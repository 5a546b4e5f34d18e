"""Whole-layer runs in dependency order."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from wakeline.operators.gates import MISSION_WINDOW, missions_gate
from wakeline.plans import business as B, serving as S
from wakeline.session import stored
from wakeline.sources.tables import BucketTable


def bl_rebuild(
    missions: DataFrame, ship_state: DataFrame, reports: DataFrame, manifests: DataFrame, as_of, keep: bool = False
) -> dict[str, DataFrame]:
    """The four summaries from scratch.

    With ``keep`` the mission and cargo summaries are stored, so the destination summary does not compute them again: for
    callers that use all four.
    """
    operations = B.mission_summary(missions, ship_state, as_of)
    cargo = B.cargo_summary(missions, reports, as_of)
    if keep:
        operations, cargo = stored(operations, "operations"), stored(cargo, "cargo")
    return {
        "mission_summary": operations,
        "cargo_summary": cargo,
        "manifest_summary": B.manifest_summary(missions, manifests, as_of),
        "planet_summary": B.planet_summary(missions, operations, cargo, as_of),
    }


def bl_refresh(tables: dict[str, DataFrame], as_of: datetime | str) -> dict[str, DataFrame]:
    """The four summaries after an incremental run, as plans.

    ``tables``: ``missions, ship_state, mission_reports, manifests`` and the current four summaries. The destination
    summary sees the refreshed mission and cargo summaries.
    """
    t = tables
    operations = B.refresh_mission_summary(t["mission_summary"], t["missions"], t["ship_state"], as_of)
    cargo = B.refresh_cargo_summary(t["cargo_summary"], t["missions"], t["mission_reports"], as_of)
    return {
        "mission_summary": operations,
        "cargo_summary": cargo,
        "manifest_summary": B.refresh_manifest_summary(t["manifest_summary"], t["missions"], t["manifests"], as_of),
        "planet_summary": B.refresh_planet_summary(t["planet_summary"], t["missions"], operations, cargo, as_of),
    }


def sl_rebuild(summaries: dict[str, DataFrame], as_of: datetime | str) -> dict[str, DataFrame]:
    """The four marts."""
    operations, cargo = summaries["mission_summary"], summaries["cargo_summary"]
    return {
        "mart_fleet_kpis": S.mart_fleet_kpis(operations, cargo, as_of),
        "mart_captain_performance": S.mart_captain_performance(operations, cargo, as_of),
        "mart_planet_performance": S.mart_planet_performance(summaries["planet_summary"], operations, cargo, as_of),
        "mart_ship_performance": S.mart_ship_performance(operations, cargo, as_of),
    }


#: Summaries with their key, and what a refresh updates of a known key.
SUMMARIES = {
    "mission_summary": ("mission_id", B.MISSION_UPDATE_COLS),
    "cargo_summary": ("mission_id", B.CARGO_UPDATE_COLS),
    "manifest_summary": ("mission_id", B.MANIFEST_UPDATE_COLS),
    "planet_summary": ("planet", B.PLANET_UPDATE_COLS),
}


def store_summaries(spark: SparkSession, root: str, summaries: dict[str, DataFrame], buckets: int = 64) -> dict[str, BucketTable]:
    """The four summaries as tables by bucket of their key below ``root``, filled as version 0."""
    tables = {}
    for name, df in summaries.items():
        key, _ = SUMMARIES[name]
        tables[name] = BucketTable(spark, f"{root}/{name}", (key,), df.schema, buckets=buckets if key == "mission_id" else 1)
        tables[name].put(df, 0)
    return tables


def run_bl_refresh(
    tables: dict[str, BucketTable],
    sources: dict[str, DataFrame],
    as_of: datetime | str,
    version: int,
    window: timedelta = MISSION_WINDOW,
) -> dict[str, list[int]] | None:
    """Gate, then refresh the stored summaries as ``version``; None when no mission was updated within ``window``.

    Only children of missions due for a refresh are aggregated, and only the buckets such missions fall in are joined and
    rewritten: returned by table. A run repeated under its version starts from what was there before it. Each summary is
    written before the next one reads it, so a later stage starts from stored rows and not from the whole lineage.
    """
    if not missions_gate(sources["missions"], as_of, window).first()["should_run"]:
        return None
    now = {name: table.read(below=version) for name, table in tables.items()}
    missions = sources["missions"]
    changed = B.changed_missions(missions, now["mission_summary"])
    due = B.cargo_due_missions(missions, now["cargo_summary"], as_of)
    ticks = sources["ship_state"].join(changed.select("mission_id"), "mission_id", "left_semi")
    reports = sources["mission_reports"].join(due.select("mission_id"), "mission_id", "left_semi")
    touched = {}

    def put(name: str, batch: DataFrame) -> None:
        touched[name] = tables[name].put(batch, version, list(SUMMARIES[name][1]))

    put("mission_summary", B.mission_batch(now["mission_summary"], missions, ticks, as_of))
    put("cargo_summary", B.cargo_batch(now["cargo_summary"], missions, reports, as_of))
    put("manifest_summary", B.manifest_batch(now["manifest_summary"], missions, sources["manifests"], as_of))
    operations, cargo = tables["mission_summary"].read(), tables["cargo_summary"].read()
    put("planet_summary", B.planet_summary(missions, operations, cargo, as_of))
    return touched
