"""Serving layer: fleet, captain, destination and ship marts over the mission and cargo summaries.

Each mart adds up exact decimals per (finest) group first and divides once at the end, so results do not depend on
task order. No mart joins back to row level: destination and favourite-ship lookups happen on aggregated rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wakeline import catalogue as C
from wakeline.functions.numeric import count_ratio, ratio, round_numeric
from wakeline.functions.times import instant
from wakeline.operators.aggregates import MONEY, average, count_where, sum_and_count
from wakeline.session import stored
from wakeline.sources.tables import BucketTable

_MEASURES = {
    "health": "avg_health",
    "uptime": "uptime_ratio",
    "fuel": "min_fuel_prc",
    "temp": "max_temp_c",
    "duration": "mission_duration_hr",
    "value": "total_value_poko",
}


def mission_facts(missions_bl: DataFrame, cargo_bl: DataFrame) -> DataFrame:
    """Mission summary with its cargo value, one row per mission."""
    value = cargo_bl.select("mission_id", "total_value_poko")
    return missions_bl.join(value, "mission_id", "left")


def _parts(measures: tuple[str, ...]) -> list[Column]:
    """Mergeable parts of every measure a mart needs."""
    sums = [c for m in measures for c in sum_and_count(_MEASURES[m], m)]
    return [
        F.count("mission_id").alias("missions"),
        F.count(F.lit(1)).alias("rows"),
        count_where(F.col("status") == C.SUCCESS).alias("success"),
        count_where(F.col("status") == C.FAILURE).alias("failure"),
        *sums,
    ]


def _merged(measures: tuple[str, ...]) -> list[Column]:
    names = ["missions", "rows", "success", "failure", *[f"{m}_{s}" for m in measures for s in ("sum", "n")]]
    return [F.sum(n).alias(n) for n in names]


def _avg(measure: str, digits: int, factor: int = 1) -> Column:
    mean = average(measure)
    return round_numeric(mean * factor if factor != 1 else mean, digits)


def _total() -> Column:
    return round_numeric(F.col("value_sum"), 0)


def _per(count: Column) -> Column:
    return round_numeric(ratio(F.col("value_sum").cast(MONEY), count), 2)


def _success_pct() -> Column:
    return round_numeric(count_ratio(F.col("success"), F.col("rows")) * 100, 1)


def _of_missions(missions_bl: DataFrame, cargo_bl: DataFrame):
    """Groups of missions with their parts, for a mart: ``grouped(keys, measures, ...)``."""
    facts = mission_facts(missions_bl, cargo_bl)

    def grouped(keys: list[str], measures: tuple[str, ...], *more: Column) -> DataFrame:
        return facts.groupBy(*keys).agg(*_parts(measures), *more)

    return grouped


def mart_fleet_kpis(missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str) -> DataFrame:
    """One row for the whole fleet, also without missions."""
    return _fleet(_of_missions(missions_bl, cargo_bl), as_of)


def _fleet(grouped, as_of: datetime | str) -> DataFrame:
    measures = ("health", "uptime", "fuel", "temp", "value")
    ships = grouped(["ship_name"], measures)
    fleet = ships.agg(*_merged(measures), F.count("ship_name").alias("ships"))
    return fleet.select(
        F.coalesce("missions", F.lit(0)).alias("nb_missions_total"),
        F.col("ships").alias("nb_ships_total"),
        _avg("health", 3).alias("avg_fleet_health"),
        _avg("uptime", 1, 100).alias("avg_uptime_pct"),
        _avg("fuel", 1).alias("avg_min_fuel_prc"),
        _avg("temp", 1).alias("avg_max_temp_c"),
        _total().alias("total_value_poko"),
        _per(F.col("ships")).alias("avg_value_per_ship"),
        instant(as_of).alias("computed_at"),
    )


def mart_captain_performance(missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str) -> DataFrame:
    """Captain leaderboard by total value, with the most flown ship.

    One pass by (captain, ship) yields both the measures' parts and the ship counts the favourite is picked from.
    """
    return _captains(_of_missions(missions_bl, cargo_bl), as_of)


def _captains(grouped, as_of: datetime | str) -> DataFrame:
    measures = ("health", "uptime", "value")
    pairs = grouped(["captain", "ship_name"], measures)
    most_flown = F.min(F.struct((-F.col("rows")).alias("negated"), F.col("ship_name").alias("ship"))).alias("fav")
    captains = pairs.groupBy("captain").agg(*_merged(measures), most_flown)
    return captains.select(
        "captain",
        F.col("fav.ship").alias("favorite_ship"),
        (-F.col("fav.negated")).alias("nb_fav_ship_missions"),
        F.col("missions").alias("nb_missions_done"),
        _avg("health", 3).alias("avg_mission_health"),
        _avg("uptime", 1, 100).alias("avg_uptime_pct"),
        _avg("value", 0).alias("avg_value_poko"),
        _total().alias("total_value_poko"),
        round_numeric(count_ratio(F.col("success"), F.col("rows")), 2).alias("success_rate"),
        instant(as_of).alias("computed_at"),
    ).orderBy(F.desc_nulls_first("total_value_poko"), "captain")


def mart_planet_performance(
    planets_bl: DataFrame, missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Destination ranking by missions. A destination without missions counts as one empty row in its rates."""
    return _planets(_of_missions(missions_bl, cargo_bl), planets_bl, as_of)


def _planets(grouped, planets_bl: DataFrame, as_of: datetime | str) -> DataFrame:
    measures = ("health", "uptime", "fuel", "temp", "value")
    by_ship = grouped(["target", "ship_name"], measures)
    by_target = by_ship.groupBy("target").agg(*_merged(measures), F.count("ship_name").alias("ships"))
    joined = planets_bl.select("planet").join(by_target, F.col("planet") == F.col("target"), "left")
    filled = joined.fillna(0, ["missions", "success", "failure", "ships"]).fillna(1, ["rows"])
    return filled.select(
        F.col("planet").alias("planet_name"),
        F.col("missions").alias("nb_missions_total"),
        F.col("success").alias("nb_missions_success"),
        F.col("failure").alias("nb_missions_failure"),
        _success_pct().alias("success_rate_pct"),
        _avg("health", 3).alias("avg_health"),
        _avg("uptime", 1, 100).alias("avg_uptime_pct"),
        _avg("fuel", 1).alias("avg_min_fuel_prc"),
        _avg("temp", 1).alias("avg_max_temp_c"),
        _total().alias("total_value_poko"),
        _per(F.col("ships")).alias("avg_value_per_ship"),
        _per(F.col("rows")).alias("avg_value_per_mission"),
        instant(as_of).alias("computed_at"),
    ).orderBy(F.desc_nulls_first("nb_missions_total"), "planet_name")


def mart_ship_performance(missions_bl: DataFrame, cargo_bl: DataFrame, as_of: datetime | str) -> DataFrame:
    """Ship leaderboard by total value."""
    return _ships(_of_missions(missions_bl, cargo_bl), as_of)


def _ships(grouped, as_of: datetime | str) -> DataFrame:
    measures = ("health", "uptime", "fuel", "temp", "duration", "value")
    ships = grouped(["ship_name"], measures, F.max("finished_at").alias("last_mission_end"))
    return ships.select(
        "ship_name",
        F.col("missions").alias("nb_missions_total"),
        F.col("success").alias("nb_missions_success"),
        F.col("failure").alias("nb_missions_failure"),
        _success_pct().alias("success_rate_pct"),
        _avg("health", 3).alias("avg_health"),
        _avg("uptime", 1, 100).alias("avg_uptime_pct"),
        _avg("fuel", 1).alias("avg_min_fuel_prc"),
        _avg("temp", 1).alias("avg_max_temp_c"),
        _avg("duration", 2).alias("avg_duration_hr"),
        _total().alias("total_value_poko"),
        _per(F.col("rows")).alias("avg_value_per_mission"),
        "last_mission_end",
        instant(as_of).alias("computed_at"),
    ).orderBy(F.desc_nulls_first("total_value_poko"), "ship_name")


#: What the marts group by, and the parts of all measures that a group of missions adds up to.
CELL = ["ship_name", "captain", "target"]
_ALL = tuple(_MEASURES)


@dataclass(frozen=True)
class KeptMarts:
    """Marts that follow the summaries: a share per mission and sums per (ship, captain, destination), stored by bucket.

    A run takes the new facts of the missions that changed. Their old shares are taken off the sums of their cells and the
    new ones put on; only buckets with such missions or cells are read and rewritten. The latest end of a mission is a
    maximum: where the share that held it changes, it is found again among the shares of that cell alone. Cells that move
    are stored before they are looked up, so shares are read once for the old ones and once for those maxima.
    """

    shares: BucketTable
    cells: BucketTable

    @staticmethod
    def build(spark: SparkSession, root: str, facts: DataFrame, buckets: int = 64) -> KeptMarts:
        """From the facts of all missions (``mission_facts``), as version 0 below ``root``."""
        facts = facts.select("mission_id", *CELL, "status", "finished_at", *_MEASURES.values())
        kept = KeptMarts(
            BucketTable(spark, f"{root}/shares", ("mission_id",), facts.schema, buckets=buckets),
            BucketTable(spark, f"{root}/cells", tuple(CELL), _cells(facts).schema, buckets=buckets),
        )
        kept.shares.put(facts, 0)
        kept.cells.put(_cells(kept.shares.read()), 0)
        return kept

    def update(self, changed: DataFrame, version: int) -> tuple[list[int], list[int]]:
        """Put the new facts of some missions in the place of their old ones, as ``version``; returns the buckets of
        shares and cells that were rewritten. A run repeated under its version starts from what was there before it."""
        spark = self.shares.spark
        changed = changed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.shares.schema.fields])
        staged = f"{self.shares.path}/_news/version={version}"
        changed.write.mode("overwrite").parquet(staged)
        changed = spark.read.schema(self.shares.schema).parquet(staged)
        shares, now = self.shares.read(below=version), self.cells.read(below=version)
        old = shares.join(changed.select("mission_id"), "mission_id", "left_semi")
        parts = [c for c in now.columns if c not in (*CELL, "last_mission_end")]
        gone = _cells(old).select(*CELL, *[(-F.col(c)).alias(c) for c in parts], F.col("last_mission_end").alias("gone_end"))
        come = _cells(changed).withColumnRenamed("last_mission_end", "come_end")
        moved = stored(gone.unionByName(come, allowMissingColumns=True), "moved")
        touched = _tagged(moved.select(*CELL).distinct())
        held = _tagged(now).join(touched.select("_cell"), "_cell", "left_semi").drop("_cell").withColumnRenamed("last_mission_end", "held_end")
        sums = [F.sum(c).cast(now.schema[c].dataType).alias(c) for c in parts]
        ends = [F.max(c).alias(c) for c in ("held_end", "gone_end", "come_end")]
        after = held.unionByName(moved, allowMissingColumns=True).groupBy(*CELL).agg(*sums, *ends)
        lost = F.col("gone_end").isNotNull() & (F.col("gone_end") >= F.col("held_end"))
        after = stored(_tagged(after.withColumn("lost", F.coalesce(lost, F.lit(False)))), "after")
        of_lost = _tagged(shares).join(after.where("lost").select("_cell"), "_cell", "left_semi")
        stay = of_lost.join(changed.select("mission_id"), "mission_id", "left_anti")
        again = stay.groupBy("_cell").agg(F.max("finished_at").alias("stay_end"))
        after = after.join(again, "_cell", "left")
        end = F.greatest(F.when(F.col("lost"), F.col("stay_end")).otherwise(F.col("held_end")), "come_end")
        cells = self.cells.put(after.withColumn("last_mission_end", end), version)
        return self.shares.put(changed, version), cells

    def marts(self, planets_bl: DataFrame, as_of: datetime | str) -> dict[str, DataFrame]:
        """The four marts from the stored sums."""
        cells = self.cells.read().where("rows > 0")

        def grouped(keys: list[str], measures: tuple[str, ...], *more: Column) -> DataFrame:
            ends = [F.max("last_mission_end").alias("last_mission_end")] if more else []
            return cells.groupBy(*keys).agg(*_merged(measures), *ends)

        return {
            "mart_fleet_kpis": _fleet(grouped, as_of),
            "mart_captain_performance": _captains(grouped, as_of),
            "mart_planet_performance": _planets(grouped, planets_bl, as_of),
            "mart_ship_performance": _ships(grouped, as_of),
        }


def _cells(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*CELL).agg(*_parts(_ALL), F.max("finished_at").alias("last_mission_end"))


def _tagged(rows: DataFrame) -> DataFrame:
    """With ``_cell``, the cell as one value that joins where names are null."""
    return rows.withColumn("_cell", F.struct(*CELL))
