
from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from checks import sql as Q
from checks.bindings import ANCHOR_EV, AS_OF, AS_OF_EV, MID_EV, T1, Bound, events_as_records, terminal_commands
from checks.present import present
from wakeline import catalogue as C
from wakeline.functions import numeric as N, text as X, times as TM
from wakeline.functions.health import score_health, subsystem_scores
from wakeline.operators import aggregates as A, distinct as D, gates as G, keys as K, quality as DQ, registry as R, reshape as RS
from wakeline.operators.skew import sliced_join
from wakeline.plans import business as B, ingest as I, radar as RD, refresh as RF, reports as RP, serving as S
from wakeline.schemas import MANIFESTS, MISSION_REPORTS, SHIP_STATE
from wakeline.session import stored, work_path
from wakeline.sinks import files as SF
from wakeline.sinks.days import DayLake
from wakeline.sinks.lake import write_lake
from wakeline.sinks.landing import append_landing, ingested_only, read_landing
from wakeline.sources.dimensions import planets, unknown_targets, with_arrival, with_target_position
from wakeline.sources.files import file_hashes, newest_run, read_manifest_rows, read_mission_logs, read_report_rows, stream_manifest_rows
from wakeline.sources.tables import TableStore
from wakeline.sources.telemetry import malformed, parse_telemetry, read_lake
from wakeline.streaming import jobs as J

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of ``Bound`` under its own name."""

    def add(fn: Callable[[Bound], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Bound(spark, sf_dir))
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def _summaries(b: Bound) -> dict[str, DataFrame]:
    return RF.bl_rebuild(b.missions, b.ship_state, b.mission_reports, b.manifests, AS_OF)


def _mart_inputs(b: Bound) -> tuple[DataFrame, DataFrame]:
    return B.mission_summary(b.missions, b.ship_state, AS_OF), B.cargo_summary(b.missions, b.mission_reports, AS_OF)


def _early_reports(b: Bound) -> DataFrame:
    return b.mission_reports.where(F.col("timestamp") < TM.instant(T1))


def _refreshed(b: Bound) -> dict[str, DataFrame]:
    """All four summaries as of T1, refreshed to AS_OF."""
    sources = {"missions": b.missions, "ship_state": b.ship_state, "mission_reports": b.mission_reports, "manifests": b.manifests}
    early = RF.bl_rebuild(b.early_missions, b.early_ship_state, _early_reports(b), b.early_manifests, T1)
    return RF.bl_refresh({**sources, **early}, AS_OF)


def _refreshed_operations(b: Bound) -> DataFrame:
    early = B.mission_summary(b.early_missions, b.early_ship_state, T1)
    return B.refresh_mission_summary(early, b.missions, b.ship_state, AS_OF)


def _refreshed_cargo(b: Bound) -> DataFrame:
    early = B.cargo_summary(b.early_missions, _early_reports(b), T1)
    return B.refresh_cargo_summary(early, b.missions, b.mission_reports, AS_OF)


# --- serving layer -----------------------------------------------------------------------------------------------

_SHIP_MART = f"""SELECT ship_name, count(*) AS nb_missions_total,
  count(*) FILTER (status = 'SUCCESS') AS nb_missions_success, count(*) FILTER (status = 'FAILURE') AS nb_missions_failure,
  {Q.numeric("100.0 * count(*) FILTER (status = 'SUCCESS') / count(*)", 1)} AS success_rate_pct,
  {Q.numeric("avg(avg_health)", 3)} AS avg_health, {Q.numeric("100 * avg(uptime_ratio)", 1)} AS avg_uptime_pct,
  {Q.numeric("avg(min_fuel_prc)", 1)} AS avg_min_fuel_prc, {Q.numeric("avg(max_temp_c)", 1)} AS avg_max_temp_c,
  {Q.numeric("avg(mission_duration_hr)", 2)} AS avg_duration_hr, {Q.num('round(sum(total_value_poko), 0)', 6)} AS total_value_poko,
  {Q.numeric("CAST(sum(total_value_poko) AS DOUBLE) / count(*)", 2)} AS avg_value_per_mission,
  {Q.ts('max(finished_at)')} AS last_mission_end, {Q.ts(Q.AS_OF)} AS computed_at
FROM operations JOIN cargo USING (mission_id, ship_name) GROUP BY ship_name"""


@query(Q.sql(Q.BL, _SHIP_MART))
def mart_ship_performance(b: Bound) -> DataFrame:
    return present(S.mart_ship_performance(*_mart_inputs(b), AS_OF))


_FLEET_MART = f"""SELECT count(DISTINCT mission_id) AS nb_missions_total, count(DISTINCT ship_name) AS nb_ships_total,
  {Q.numeric("avg(avg_health)", 3)} AS avg_fleet_health, {Q.numeric("100 * avg(uptime_ratio)", 1)} AS avg_uptime_pct,
  {Q.numeric("avg(min_fuel_prc)", 1)} AS avg_min_fuel_prc, {Q.numeric("avg(max_temp_c)", 1)} AS avg_max_temp_c,
  {Q.num('round(sum(total_value_poko), 0)', 6)} AS total_value_poko,
  {Q.numeric("CAST(sum(total_value_poko) AS DOUBLE) / count(DISTINCT ship_name)", 2)} AS avg_value_per_ship,
  {Q.ts(Q.AS_OF)} AS computed_at
FROM operations JOIN cargo USING (mission_id, ship_name)"""


@query(Q.sql(Q.BL, _FLEET_MART))
def mart_fleet_kpis(b: Bound) -> DataFrame:
    return present(S.mart_fleet_kpis(*_mart_inputs(b), AS_OF))


_FAVOURITE = """favourite AS (
  SELECT captain, ship_name AS favorite_ship, n AS nb_fav_ship_missions FROM (
    SELECT captain, ship_name, count(*) AS n, row_number() OVER (PARTITION BY captain ORDER BY count(*) DESC, ship_name) AS rn
    FROM missions GROUP BY captain, ship_name) WHERE rn = 1)"""


@query(
    Q.sql(
        [*Q.BL, _FAVOURITE],
        f"""SELECT o.captain, favorite_ship, nb_fav_ship_missions, count(*) AS nb_missions_done,
  {Q.numeric("avg(avg_health)", 3)} AS avg_mission_health, {Q.numeric("100 * avg(uptime_ratio)", 1)} AS avg_uptime_pct,
  {Q.numeric("avg(total_value_poko)", 0)} AS avg_value_poko, {Q.num('round(sum(total_value_poko), 0)', 6)} AS total_value_poko,
  {Q.numeric("1.0 * count(*) FILTER (status = 'SUCCESS') / count(*)", 2)} AS success_rate, {Q.ts(Q.AS_OF)} AS computed_at
FROM operations o JOIN cargo USING (mission_id) JOIN favourite f ON f.captain = o.captain
GROUP BY o.captain, favorite_ship, nb_fav_ship_missions""",
    )
)
def mart_captain_performance(b: Bound) -> DataFrame:
    return present(S.mart_captain_performance(*_mart_inputs(b), AS_OF))


_PLANET_MART = f"""SELECT planet AS planet_name, count(DISTINCT mission_id) AS nb_missions_total,
  count(*) FILTER (status = 'SUCCESS') AS nb_missions_success, count(*) FILTER (status = 'FAILURE') AS nb_missions_failure,
  {Q.numeric("100.0 * count(*) FILTER (status = 'SUCCESS') / count(*)", 1)} AS success_rate_pct,
  {Q.numeric("avg(o.avg_health)", 3)} AS avg_health, {Q.numeric("100 * avg(uptime_ratio)", 1)} AS avg_uptime_pct,
  {Q.numeric("avg(min_fuel_prc)", 1)} AS avg_min_fuel_prc, {Q.numeric("avg(max_temp_c)", 1)} AS avg_max_temp_c,
  {Q.num('round(sum(total_value_poko), 0)', 6)} AS total_value_poko,
  {Q.numeric("CAST(sum(total_value_poko) AS DOUBLE) / count(DISTINCT o.ship_name)", 2)} AS avg_value_per_ship,
  {Q.numeric("CAST(sum(total_value_poko) AS DOUBLE) / count(*)", 2)} AS avg_value_per_mission, {Q.ts(Q.AS_OF)} AS computed_at
FROM planets p LEFT JOIN operations o ON o.target = p.planet LEFT JOIN cargo c USING (mission_id) GROUP BY planet"""


@query(Q.sql(Q.BL, _PLANET_MART))
def mart_planet_performance(b: Bound) -> DataFrame:
    bl = _summaries(b)
    return present(S.mart_planet_performance(bl["planet_summary"], bl["mission_summary"], bl["cargo_summary"], AS_OF))


@query(Q.sql([Q.MISSIONS, _FAVOURITE], "SELECT * FROM favourite"))
def captain_favorite_ship(b: Bound) -> DataFrame:
    return A.favourite_ship(b.missions)


# --- business layer ----------------------------------------------------------------------------------------------


@query(Q.sql(Q.BL, Q.operations_out()))
def bl_mission_summary(b: Bound) -> DataFrame:
    return present(B.mission_summary(b.missions, b.ship_state, AS_OF))


@query(Q.sql(Q.BL, Q.cargo_out()))
def bl_cargo_summary(b: Bound) -> DataFrame:
    return present(B.cargo_summary(b.missions, b.mission_reports, AS_OF))


@query(Q.sql(Q.BL, Q.uploads_out()))
def bl_manifest_summary(b: Bound) -> DataFrame:
    return present(B.manifest_summary(b.missions, b.manifests, AS_OF))


@query(Q.sql(Q.BL, Q.planets_out()))
def bl_planet_summary(b: Bound) -> DataFrame:
    return present(_summaries(b)["planet_summary"])


@query(Q.sql(Q.REFRESH, Q.operations_out()))
def upsert_mission_summary(b: Bound) -> DataFrame:
    return present(_refreshed_operations(b))


@query(Q.sql(Q.REFRESH, Q.cargo_out()))
def upsert_cargo_summary(b: Bound) -> DataFrame:
    return present(_refreshed_cargo(b))


@query(Q.sql(Q.REFRESH, Q.uploads_out()))
def upsert_manifest_summary(b: Bound) -> DataFrame:
    early = B.manifest_summary(b.early_missions, b.early_manifests, T1)
    return present(B.refresh_manifest_summary(early, b.missions, b.manifests, AS_OF))


@query(Q.sql(Q.REFRESH, Q.planets_out()))
def upsert_planet_summary(b: Bound) -> DataFrame:
    return present(_refreshed(b)["planet_summary"])


@query(
    Q.sql(
        Q.REFRESH,
        """SELECT o.status AS summary_status, m.status AS live_status, count(*) AS nb_missions
FROM operations o JOIN missions m USING (mission_id) WHERE o.status <> m.status GROUP BY 1, 2""",
    )
)
def stale_status_report(b: Bound) -> DataFrame:
    return B.stale_statuses(_refreshed_operations(b), b.missions)


@query(Q.sql(Q.REFRESH, _SHIP_MART))
def mart_ship_performance_after_refresh(b: Bound) -> DataFrame:
    return present(S.mart_ship_performance(_refreshed_operations(b), _refreshed_cargo(b), AS_OF))


# --- scoring and scalar functions --------------------------------------------------------------------------------


@query(
    Q.sql(
        [Q.TELEMETRY, Q.SCORED],
        """SELECT seq, mission_id, status, motor_health, engine_health, core_health, fuel_health,
  health AS normalized_health_total, ship_condition FROM scored""",
    )
)
def health_scores(b: Bound) -> DataFrame:
    scored = score_health(b.telemetry)
    names = ("motor_health", "engine_health", "core_health", "fuel_health", "normalized_health_total", "ship_condition")
    return scored.select("seq", "mission_id", "status", *names)


@query(Q.sql([Q.TELEMETRY, Q.SCORED], "SELECT ship_condition, status, count(*) AS n, sum(CAST(round(health * 1000) AS BIGINT))::BIGINT AS thousandths FROM scored GROUP BY 1, 2"))
def health_condition_counts(b: Bound) -> DataFrame:
    scored = score_health(b.telemetry)
    thousandths = F.round(F.col("normalized_health_total") * 1000).cast("bigint")
    return scored.groupBy("ship_condition", "status").agg(F.count(F.lit(1)).alias("n"), F.sum(thousandths).alias("thousandths"))


@query(
    Q.sql(
        [Q.TELEMETRY, Q.SCORED],
        """SELECT seq, m AS motor_score, e AS engine_score, c AS core_score, f AS fuel_score,
  motor_temp_c < 30 OR motor_temp_c > 180 AS motor_broken,
  engine_pressure_kpa < 100 OR engine_pressure_kpa > 600 AS engine_broken,
  power_core_temp_c < 300 OR power_core_temp_c > 950 AS core_broken, fuel_prc <= 5 AS fuel_broken FROM scored""",
    )
)
def subsystem_bands(b: Bound) -> DataFrame:
    names = [f"{n}_{s}" for n in C.HEALTH_WEIGHTS for s in ("score", "broken")]
    return subsystem_scores(b.telemetry).select("seq", *names)


@query("""SELECT event_id, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(value - 10.0::DOUBLE) / 4.0::DOUBLE)), 12) AS sigmoid,
  greatest(2.5::DOUBLE, least(20.0::DOUBLE, value)) AS clamped FROM events""")
def sigmoid(b: Bound) -> DataFrame:
    value = F.col("value")
    squashed = N.sigmoid((value - 10.0) / 4.0)
    return b.table("events").select("event_id", F.round(squashed, 12).alias("sigmoid"), N.clamp(value, 2.5, 20.0).alias("clamped"))


@query(f"""SELECT l_orderkey, l_linenumber, {Q.round_binary('p', 2)} AS binary_2, {Q.round_binary('p', 3)} AS binary_3,
  {Q.num(Q.dec('p', 18, 1))} AS numeric_1,
  (CASE WHEN l_linenumber % 2 = 1 THEN -1 ELSE 1 END) * ((t // 64 + CASE WHEN t % 64 > 32 OR (t % 64 = 32 AND (t // 64) % 2 = 1)
  THEN 1 ELSE 0 END)::DOUBLE / 100) AS large_2
  FROM (SELECT l_orderkey, l_linenumber, l_quantity / 7 AS p,
  ((l_orderkey * 134217728)::BIGINT * 64 + l_partkey * 7 % 64) * 100 AS t FROM lineitem)""")
def rounding(b: Bound) -> DataFrame:
    """Small quotients, and numbers up to 2^43 of either sign in steps of 1/64, which SQL rounds in whole numbers."""
    p = F.col("l_quantity") / 7
    sign = F.when(F.col("l_linenumber") % 2 == 1, -1.0).otherwise(1.0)
    large = (F.col("l_orderkey").cast("double") * 134217728.0 + (F.col("l_partkey") * 7 % 64) / 64.0) * sign
    numeric = N.round_numeric(p.cast("decimal(30,17)"), 1)
    return b.table("lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        N.round_binary(p, 2).alias("binary_2"),
        N.round_binary(p, 3).alias("binary_3"),
        numeric.cast("double").alias("numeric_1"),
        N.round_binary(large, 2).alias("large_2"),
    )


@query(Q.sql([Q.TELEMETRY], "SELECT seq, ship_id, distance FROM telemetry"))
def distance_from_origin(b: Bound) -> DataFrame:
    distance = N.distance_from_origin(F.col("coord_x"), F.col("coord_y"), F.col("coord_z"))
    return b.telemetry.select("seq", "ship_id", distance.alias("distance"))


@query(
    Q.sql(
        [Q.TELEMETRY, Q.places(), "numbered AS (SELECT *, row_number() OVER () - 1 AS no FROM places)"],
        f"""SELECT planet AS target, arrived, count(*) AS n FROM (
  SELECT p.planet, CASE WHEN p.planet IS NOT NULL THEN
    abs(coord_x - x) <= 2.4e6 + 1e-5 * abs(x) AND abs(coord_y - y) <= 2.4e6 + 1e-5 * abs(y)
    AND abs(coord_z - z) <= 2.4e6 + 1e-5 * abs(z) END AS arrived
  FROM telemetry t JOIN orders ON o_orderkey = t.mission JOIN customer ON c_custkey = o_custkey
  JOIN numbered p ON p.no = c_nationkey) GROUP BY 1, 2""".replace(
            "FROM telemetry t JOIN orders ON o_orderkey = t.mission JOIN customer ON c_custkey = o_custkey\n  JOIN numbered p ON p.no = c_nationkey",
            "FROM telemetry t JOIN orders ON o_orderkey = t.mission JOIN customer ON c_custkey = o_custkey\n  LEFT JOIN numbered p ON p.no = c_nationkey",
        ),
    )
)
def reached_target(b: Bound) -> DataFrame:
    places = planets(b.spark)
    numbers = {name: i for i, (name, *_) in enumerate(C.PLANETS)}
    by_nation = F.create_map(*[F.lit(x) for name, i in numbers.items() for x in (i, name)])
    homes = b.table("customer").select("c_custkey", F.try_element_at(by_nation, F.col("c_nationkey")).alias("target"))
    targets = b.table("orders").join(homes, F.col("o_custkey") == F.col("c_custkey"))
    targets = targets.select(F.col("o_orderkey").cast("string").alias("mission_id"), "target")
    ticks = sliced_join(b.telemetry, targets, "mission_id", F.col("seq"))
    arrived = with_arrival(with_target_position(ticks, places))
    return arrived.groupBy("target", "arrived").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT n_name AS target, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE n_nationkey >= {len(C.PLANETS)} GROUP BY 1"""
)
def unknown_destinations(b: Bound) -> DataFrame:
    """Nations stand for the destination of their number; those beyond the last destination keep their own name."""
    names = F.create_map(*[F.lit(x) for i, (name, *_) in enumerate(C.PLANETS) for x in (i, name)])
    homes = b.table("customer").join(b.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    homes = homes.select("c_custkey", F.coalesce(F.try_element_at(names, F.col("c_nationkey").cast("int")), "n_name").alias("target"))
    missions = b.table("orders").join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return unknown_targets(missions, planets(b.spark)).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query(Q.sql([Q.MISSIONS], f"SELECT mission_id, round(epoch(coalesce(finished_at, {Q.AS_OF}) - started_at) / 3600.0, 6) AS duration_hr FROM missions"))
def duration_hours(b: Bound) -> DataFrame:
    hours = TM.duration_hours(F.col("started_at"), F.col("finished_at"), AS_OF)
    return present(b.missions.select("mission_id", hours.alias("duration_hr")))


@query("""SELECT o_orderkey, strftime(o_orderdate + INTERVAL '1000' YEAR, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
  strftime(o_orderdate + INTERVAL '1000' YEAR, '%Y-%m-%dT%H-%M-%SZ') AS tag,
  strftime(o_orderdate + INTERVAL '1000' YEAR, '%Y%m%d') AS day FROM orders""")
def far_future_shift(b: Bound) -> DataFrame:
    at = TM.far_future(F.col("o_orderdate"))
    return b.table("orders").select(
        "o_orderkey",
        TM.iso_seconds(at).alias("stamp"),
        TM.file_time_tag(at).alias("tag"),
        F.date_format(at, "yyyyMMdd").alias("day"),
    )


@query(Q.sql([Q.MANIFESTS], "SELECT mission_id, strftime(mission_date, '%Y-%m-%d') AS mission_date, mission_file, manifest_path FROM manifests"))
def object_keys(b: Bound) -> DataFrame:
    return present(b.manifests.select("mission_id", "mission_date", "mission_file", "manifest_path"))


_NAMES = """names AS (
  SELECT o_orderkey, CASE o_orderstatus
    WHEN 'F' THEN 'mission_' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d') || '.parquet'
    WHEN 'P' THEN 'manifest_' || strftime(o_orderdate, '%Y%m%d') || '.json'
    ELSE 'foo' || o_orderkey || '.tar.gz' END AS name FROM orders)"""


@query(
    Q.sql(
        [_NAMES],
        """SELECT o_orderkey, name, regexp_replace(name, '\\.[^.]*$', '') AS stem,
  CASE WHEN name LIKE 'mission%' THEN CAST(o_orderkey AS VARCHAR) ELSE 'unknown' END AS mission_id,
  CASE WHEN name LIKE 'mission%' THEN 'mission' WHEN name LIKE 'manifest%' THEN 'manifest' ELSE 'file' END AS log_type
FROM names""",
    )
)
def file_name_parse(b: Bound) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    key = F.col("o_orderkey").cast("string")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("mission_"), key, F.lit("_"), day, F.lit(".parquet")))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("manifest_"), day, F.lit(".json")))
        .otherwise(F.concat(F.lit("foo"), key, F.lit(".tar.gz")))
    )
    stem = X.file_stem(F.col("name"))
    return b.table("orders").select("o_orderkey", name.alias("name")).select(
        "o_orderkey", "name", stem.alias("stem"), X.stem_mission_id(stem).alias("mission_id"), X.stem_log_type(stem).alias("log_type")
    )


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256_payload(b: Bound) -> DataFrame:
    return b.table("documents").select("doc_id", X.sha256_hex(F.col("text").cast("binary")).alias("sha256"))


@query(
    Q.sql(
        [Q.TELEMETRY],
        """SELECT seq, upper(lower(status)) AS status,
  CASE status WHEN 'REPAIR' THEN '#ff3333' WHEN 'FAILURE' THEN '#888888' ELSE '#ffaa00' END AS colour,
  CASE status WHEN 'OK' THEN 'yellow' WHEN 'REPAIR' THEN 'red' WHEN 'FAILURE' THEN 'black' ELSE 'blue' END AS marker,
  CASE WHEN mission_status = 'SUCCESS' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS success_flag,
  CASE WHEN ship_id = 'SS_00' THEN 'UNKNOWN' ELSE ship_id END AS ship FROM telemetry""",
    )
)
def status_labels(b: Bound) -> DataFrame:
    status = F.col("status")
    blanked = F.when(F.col("ship_id") != "SS_00", F.col("ship_id")).otherwise("")
    return b.telemetry.select(
        "seq",
        X.normal_status(F.lower(status)).alias("status"),
        X.status_colour(status).alias("colour"),
        X.status_marker(status).alias("marker"),
        X.flag(F.lower("mission_status"), "SUCCESS").alias("success_flag"),
        X.ship_or_unknown(blanked).alias("ship"),
    )


# --- mission registry --------------------------------------------------------------------------------------------


@query(
    Q.sql(
        [Q.MISSIONS, Q.EARLY_MISSIONS],
        f"""SELECT mission_id, ship_name, captain, target, report_freq_min, status, {Q.ts('started_at')} AS started_at,
  {Q.ts('finished_at')} AS finished_at, {Q.ts('coalesce(finished_at, started_at)')} AS updated_at FROM early_missions
UNION ALL
SELECT (SELECT max(mission_id) FROM early_missions) + row_number() OVER (ORDER BY mission_id), ship_name, captain, target,
  report_freq_min, 'RUNNING', {Q.ts(Q.AS_OF)}, NULL, {Q.ts(Q.AS_OF)} FROM missions WHERE started_at >= {Q.T1}""",
    )
)
def register_missions(b: Bound) -> DataFrame:
    late = b.missions.where(F.col("started_at") >= TM.instant(T1)).withColumnRenamed("mission_id", "request_id")
    requests = late.select("request_id", "ship_name", "captain", "target", "report_freq_min")
    return present(R.register(b.early_missions, requests, AS_OF))


_COMMANDS = """commands AS (
  SELECT mission AS mission_id, arg_max(mission_status, seq) AS status FROM telemetry WHERE mission_status IS NOT NULL GROUP BY 1)"""


@query(
    Q.sql(
        [Q.MISSIONS, Q.EARLY_MISSIONS, Q.TELEMETRY, _COMMANDS],
        f"""SELECT mission_id, ship_name, captain, target, report_freq_min, coalesce(c.status, m.status) AS status,
  {Q.ts('started_at')} AS started_at, {Q.ts(f'CASE WHEN c.status IS NULL THEN finished_at ELSE {Q.AS_OF} END')} AS finished_at,
  {Q.ts(f'CASE WHEN c.status IS NULL THEN coalesce(finished_at, started_at) ELSE {Q.AS_OF} END')} AS updated_at
FROM early_missions m LEFT JOIN commands c USING (mission_id)""",
    )
)
def complete_missions(b: Bound) -> DataFrame:
    return present(R.complete(b.early_missions, terminal_commands(b.telemetry), AS_OF)[0])


@query(
    Q.sql(
        [Q.MISSIONS, Q.EARLY_MISSIONS, Q.TELEMETRY, _COMMANDS],
        "SELECT mission_id FROM commands WHERE mission_id NOT IN (SELECT mission_id FROM early_missions)",
    )
)
def complete_not_found(b: Bound) -> DataFrame:
    return R.complete(b.early_missions, terminal_commands(b.telemetry), AS_OF)[1]


@query(
    Q.sql(
        [Q.MISSIONS, Q.MANIFESTS],
        f"""SELECT mission_id, {Q.ts('greatest(coalesce(finished_at, started_at), last)')} AS updated_at FROM missions
LEFT JOIN (SELECT mission_id, max(upload_time) AS last FROM manifests GROUP BY 1) USING (mission_id)""",
    )
)
def touch_updated_at(b: Bound) -> DataFrame:
    touched = R.touch_parents(b.missions, b.manifests, "upload_time")
    return present(touched.select("mission_id", "updated_at"))


# --- landing layer -----------------------------------------------------------------------------------------------


def _documents(b: Bound) -> DataFrame:
    files = b.manifests_by_mission.select(
        "mission_id", "mission_date", F.col("mission_file").alias("object_key"), F.col("checksum_mission").alias("checksum")
    )
    return RP.build_manifests(files, b.mission_states, AS_OF)


def _landing(b: Bound, keep: bool = False, keep_lineage: bool = False) -> I.Landing:
    return I.ingest_manifests(I.parse_manifests(_documents(b)), b.report_rows, b.early_manifests, AS_OF, keep, keep_lineage)


_NEW = "new AS (SELECT * FROM manifests WHERE mission_date >= DATE '1998-07-01')"


@query(Q.sql([Q.MANIFESTS, _NEW], "SELECT mission_id, strftime(mission_date, '%Y-%m-%d') AS mission_date, manifest_path FROM new"))
def manifests_new(b: Bound) -> DataFrame:
    fresh = I.new_manifests(I.parse_manifests(_documents(b)), b.early_manifests)
    return present(fresh.select("mission_id", "mission_date", "manifest_path"))


@query(
    Q.sql(
        [Q.REPORTS, Q.MANIFESTS, _NEW],
        f"""SELECT r.mission_id, item, {Q.num('value', 6)} AS value, {Q.ts('seen')} AS "timestamp", checksum_mission AS file_checksum,
  mission_file AS source_file, {Q.ts(Q.AS_OF)} AS loaded_at
FROM reports r JOIN new n ON n.mission_id = r.mission_id AND n.mission_date = CAST(r.seen AS DATE)""",
    )
)
def mission_reports_landing(b: Bound) -> DataFrame:
    return present(_landing(b, keep_lineage=True).reports)


_LAST = """last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mission ORDER BY seq DESC) AS rn FROM scored) WHERE rn = 1)"""


@query(
    Q.sql(
        [Q.TELEMETRY, Q.SCORED, Q.MANIFESTS, _NEW, _LAST],
        f"""SELECT n.mission_id, {Q.ts(Q.AS_OF)} AS "timestamp", CAST(NULL AS VARCHAR) AS status, ship_condition,
  health AS normalized_health_total, motor_health, engine_health, core_health, fuel_health, fuel_prc,
  {Q.num(Q.dec('motor_temp_c', 5, 1))} AS temperature_C, {Q.num(Q.dec('coalesce(radiation, 0)', 8, 3))} AS radiation_uSv,
  {Q.num(Q.dec('coalesce(integrity, 100)', 5, 2))} AS cargo_integrity_prc, round(coord_x) AS coord_x, round(coord_y) AS coord_y,
  round(coord_z) AS coord_z, CASE WHEN l.status = 'REPAIR' THEN 'Ohri' ELSE 'UNKNOWN' END AS planet,
  checksum_mission AS file_checksum, mission_file AS source_file, {Q.ts(Q.AS_OF)} AS loaded_at
FROM new n JOIN last l ON l.mission = n.mission_id""",
    )
)
def manifest_states_landing(b: Bound) -> DataFrame:
    return present(_landing(b).ship_state)


@query(
    Q.sql(
        [Q.MANIFESTS, _NEW],
        """SELECT mission_id, strftime(mission_date, '%Y-%m-%d') AS mission_date, manifest_path, mission_file, checksum_mission,
  '3002-01-01 18:00:00' AS upload_time, 'INGESTED' AS status FROM new""",
    )
)
def manifest_registration(b: Bound) -> DataFrame:
    return present(_landing(b).manifests.drop("checksum_manifest"))


@query(
    Q.sql(
        [Q.MANIFESTS, _NEW],
        """SELECT mission_id, strftime(mission_date, '%Y-%m-%d') AS mission_date, manifest_path FROM new
WHERE mission_date < DATE '2000-01-01'""",
    )
)
def manifests_waiting(b: Bound) -> DataFrame:
    """Of the reports only those from 2000 on have arrived."""
    arrived = b.report_rows.where(F.col("timestamp") >= "2000-01-01")
    landing = I.ingest_manifests(I.parse_manifests(_documents(b)), arrived, b.early_manifests, AS_OF, keep=False)
    return present(landing.waiting)


def _damaged(b: Bound) -> DataFrame:
    """Manifest documents, those of every seventh mission cut, those of every eleventh without a date."""
    cut = F.element_at(F.split("manifest_path", "/"), 1).cast("bigint")
    undated = F.regexp_replace("text", '"date":', '"day":')
    return _documents(b).withColumn("text", F.when(cut % 7 == 0, "{not json").when(cut % 11 == 0, undated).otherwise(F.col("text")))


_UNREADABLE = "mission_id % 7 = 0 OR mission_id % 11 = 0"


@query(Q.sql([Q.MANIFESTS], f"SELECT manifest_path AS source, 'no readable mission or date' AS reason FROM manifests WHERE {_UNREADABLE}"))
def manifests_rejected(b: Bound) -> DataFrame:
    return I.unreadable_manifests(I.parse_manifests(_damaged(b))).select("source", "reason")


@query(
    Q.sql(
        [Q.MANIFESTS],
        f"""SELECT CASE WHEN {_UNREADABLE} THEN 'rejected' WHEN mission_date < DATE '1998-07-01' THEN 'known'
  WHEN mission_date < DATE '2000-01-01' THEN 'waiting' ELSE 'landed' END AS outcome, count(*) AS n FROM manifests GROUP BY 1""",
    )
)
def manifests_outcomes(b: Bound) -> DataFrame:
    """Every document ends in one place: landed, known before, waiting for its report, or rejected."""
    documents = I.parse_manifests(_damaged(b))
    arrived = b.report_rows.where(F.col("timestamp") >= "2000-01-01")
    landing = I.ingest_manifests(documents, arrived, b.early_manifests, AS_OF, keep=False)
    ids = documents.select(F.col("mission_id").try_cast("bigint").alias("mission_id"), F.col("date").try_cast("date").alias("mission_date"))
    known = ids.join(b.early_manifests.select("mission_id", "mission_date"), ["mission_id", "mission_date"], "left_semi")
    unreadable = landing.rejected.where(F.col("reason") == "no readable mission or date")
    places = {"landed": landing.manifests, "known": known, "waiting": landing.waiting, "rejected": unreadable}
    each = [df.select(F.lit(name).alias("outcome")) for name, df in places.items()]
    return reduce(DataFrame.unionAll, each).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    Q.sql(
        [Q.REPORTS, Q.MANIFESTS, _NEW],
        """SELECT mission_file AS source, 'report row does not fit' AS reason, count(*) AS n
FROM reports r JOIN new n ON n.mission_id = r.mission_id AND n.mission_date = CAST(r.seen AS DATE) WHERE value >= 50000 GROUP BY 1""",
    )
)
def landing_rejects(b: Bound) -> DataFrame:
    """Prices from 50000 on are made too large for their column: these rows are listed and do not land."""
    value = F.when(F.col("value") >= 50000, F.col("value") * 1e13).otherwise(F.col("value"))
    landing = I.ingest_manifests(I.parse_manifests(_documents(b)), b.report_rows.withColumn("value", value), b.early_manifests, AS_OF, keep=False)
    rows = landing.rejected.where(F.col("reason") == "report row does not fit")
    return rows.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    Q.sql(
        Q.TICKS,
        f"""SELECT mission_id, {Q.ts('ts')} AS "timestamp", status, ship_condition, {Q.num('health')} AS normalized_health_total,
  {Q.num('motor_health')} AS motor_health, {Q.num('engine_health')} AS engine_health, {Q.num('core_health')} AS core_health,
  {Q.num('fuel_health')} AS fuel_health, {Q.num('fuel')} AS fuel_prc, {Q.num('temp')} AS temperature_C,
  {Q.num('radiation')} AS radiation_uSv, {Q.num('integrity')} AS cargo_integrity_prc, CAST(coord_x AS DOUBLE) AS coord_x,
  CAST(coord_y AS DOUBLE) AS coord_y, CAST(coord_z AS DOUBLE) AS coord_z, 'UNKNOWN' AS planet FROM landing""",
    )
)
def ship_state_landing(b: Bound) -> DataFrame:
    return present(b.ship_state.drop("file_checksum", "source_file", "loaded_at"))


@query(
    Q.sql(
        [Q.TELEMETRY, Q.SCORED, Q.MANIFESTS, _LAST],
        """SELECT manifest_path, CAST(n.mission_id AS VARCHAR) AS mission_id, strftime(mission_date, '%Y-%m-%d') AS day, mission_file,
  checksum_mission AS checksum, '3002-01-01T18:00:00Z' AS upload_time, l.status AS state_status, ship_condition
FROM manifests n LEFT JOIN last l ON l.mission = n.mission_id""",
    )
)
def manifest_documents(b: Bound) -> DataFrame:
    def at(path: str):
        return F.get_json_object("text", f"$.{path}")

    return _documents(b).select(
        "manifest_path",
        at("mission_id").alias("mission_id"),
        at("date").alias("day"),
        at("files.mission").alias("mission_file"),
        at("checksum.mission").alias("checksum"),
        at("upload_time").alias("upload_time"),
        at("ship_state.status").alias("state_status"),
        at("ship_state.ship_condition").alias("ship_condition"),
    )


@query("""SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS mission_id, p_name AS item, l_quantity AS value,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM lineitem JOIN part ON p_partkey = l_partkey""")
def clean_reports(b: Bound) -> DataFrame:
    parts = b.table("part").select("p_partkey", F.col("p_name").alias("item"))
    raw = b.table("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("mission_id"),
        "item",
        F.col("l_quantity").cast("string").alias("value"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    return I.clean_reports(raw.unionAll(raw))


@query(
    Q.sql(
        [Q.MANIFESTS],
        """SELECT '3002-01-01T00:00:00Z' AS "timestamp", CAST(mission_id AS VARCHAR) AS mission_id,
  'mission_' || mission_id || '_' || strftime(mission_date, '%Y%m%d') || '.parquet' AS file_name, 'missions' AS source_bucket,
  CASE WHEN mission_date >= DATE '1998-07-01' THEN 'SUCCESS' ELSE 'FAIL' END AS status, checksum_mission AS checksum,
  '3002-01-01' AS log_date,
  '3002-01-01/mission_' || mission_id || '/log_mission_' || mission_id || '_3002-01-01T00-00-00Z.json' AS object_key
FROM manifests""",
    )
)
def audit_log(b: Bound) -> DataFrame:
    files = b.manifests.select(
        F.element_at(F.split("mission_file", "/"), -1).alias("file_name"),
        F.lit("missions").alias("source_bucket"),
        F.col("checksum_mission").alias("checksum"),
        (F.col("mission_date") >= F.lit(T1[:10]).cast("date")).alias("success"),
    )
    return RP.upload_audit_log(files, AS_OF)


# --- telemetry, radar, metrics -----------------------------------------------------------------------------------

_WIRE = """SELECT seq, "timestamp", mission_id, ship_id, coord_x, coord_y, coord_z, fuel_prc, motor_temp_c, engine_pressure_kpa,
  power_core_temp_c, navigation_signal_db, distance, status, mission_status FROM telemetry"""


@query(
    Q.sql(
        [Q.TELEMETRY],
        "SELECT ship_id AS key, count(*) FILTER (seq % 10 <> 0) AS sent, count(*) FILTER (seq % 10 = 0) AS set_aside FROM telemetry GROUP BY 1",
    )
)
def unencodable_events(b: Bound) -> DataFrame:
    """Every tenth event has a reading JSON has no form for: it is set aside, the others are sent."""
    odd = F.when(F.col("seq") % 20 == 0, F.lit(float("nan"))).when(F.col("seq") % 10 == 0, F.lit(float("inf")))
    events = b.telemetry.withColumn("fuel_prc", F.coalesce(odd, F.col("fuel_prc")))
    good, bad = RS.split_encodable(RS.to_topic_records(events))
    error = F.get_json_object("value", "$.serialization_error").isNotNull()
    each = good.select("key", F.lit(1).alias("sent"), F.lit(0).alias("set_aside"))
    each = each.unionAll(bad.select("key", F.lit(0), error.cast("int")))
    return each.groupBy("key").agg(F.sum("sent").alias("sent"), F.sum("set_aside").alias("set_aside"))


@query(Q.sql([Q.TELEMETRY], _WIRE))
def telemetry_parse_roundtrip(b: Bound) -> DataFrame:
    return J.arriving(b.topic_records).withColumnRenamed(C.ORIGIN_DISTANCE, "distance")


@query(
    Q.sql(
        [Q.TELEMETRY],
        """SELECT ship_id AS key, mission_id, fuel_prc, malfunctioned_component AS component, mission_status,
  mission_status IS NULL AS null_kept FROM telemetry""",
    )
)
def topic_records(b: Bound) -> DataFrame:
    records = RS.to_topic_records(b.telemetry, drop=("seq",))

    def at(path: str):
        return F.get_json_object("value", f"$.{path}")

    return RS.split_encodable(records)[0].select(
        "key",
        at("mission_id").alias("mission_id"),
        at("fuel_prc").cast("double").alias("fuel_prc"),
        at("malfunctioned_component").alias("component"),
        at("mission_status").alias("mission_status"),
        F.col("value").contains('"mission_status":null').alias("null_kept"),
    )


@query("SELECT count(*) AS malformed FROM events WHERE event_type = 'error'")
def malformed_records(b: Bound) -> DataFrame:
    """Cut values of error events: each must parse to an all-null row and be routed, not lost."""
    broken = F.col("event_type") == "error"
    records = b.table("events").select(F.when(broken, "{not json").otherwise(F.concat(F.lit('{"mission_id":"'), "user_id", F.lit('"}'))).alias("value"))
    return malformed(parse_telemetry(records)).agg(F.count(F.lit(1)).alias("malformed"))


_RADAR = """radar AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ship_id ORDER BY seq DESC) AS rn FROM telemetry)
  WHERE rn = 1 AND mission_status IS NULL)"""
_RADAR_OUT = """SELECT ship_id, seq, mission_id, coord_x, coord_y, status,
  CASE status WHEN 'REPAIR' THEN '#ff3333' WHEN 'FAILURE' THEN '#888888' ELSE '#ffaa00' END AS colour FROM radar"""


def _radar_columns(radar: DataFrame) -> DataFrame:
    return radar.select("ship_id", "seq", "mission_id", "coord_x", "coord_y", "status", "colour")


@query(Q.sql([Q.TELEMETRY, _RADAR], _RADAR_OUT))
def radar_latest(b: Bound) -> DataFrame:
    return _radar_columns(RD.radar_latest(b.telemetry))


@query(Q.sql([Q.TELEMETRY, _RADAR], "SELECT count(*) AS vessels FROM radar"))
def radar_active_count(b: Bound) -> DataFrame:
    return RD.active_count(RD.radar_latest(b.telemetry))


_RADAR_BEFORE = f"""before AS (
  SELECT ship_id FROM (SELECT *, row_number() OVER (PARTITION BY ship_id ORDER BY seq DESC) AS rn FROM telemetry WHERE ts < {Q.MID_EV})
  WHERE rn = 1 AND mission_status IS NULL)"""


@query(Q.sql([Q.TELEMETRY, _RADAR, _RADAR_BEFORE], "SELECT ship_id FROM before EXCEPT SELECT ship_id FROM radar"))
def radar_departed(b: Bound) -> DataFrame:
    return K.departed(RD.radar_latest(b.early_telemetry), RD.radar_latest(b.telemetry), "ship_id")


_TRANSITIONS = Q.sql(
    [Q.TELEMETRY],
    """SELECT ship_id, seq, previous, status AS current,
  CASE status WHEN 'OK' THEN 'yellow' WHEN 'REPAIR' THEN 'red' WHEN 'FAILURE' THEN 'black' ELSE 'blue' END AS marker FROM (
  SELECT ship_id, seq, status, mission_status,
         lag(CASE WHEN mission_status IS NULL THEN status END) OVER (PARTITION BY ship_id ORDER BY seq) AS previous FROM telemetry)
WHERE mission_status IS NULL AND (previous IS NULL OR previous <> status)""",
)


@query(_TRANSITIONS)
def radar_transitions(b: Bound) -> DataFrame:
    return RD.radar_transitions(b.telemetry)


_GAUGES = [("ship_fuel_percent", "fuel_prc"), ("ship_coord_x", "coord_x"), ("ship_coord_y", "coord_y"), ("ship_coord_z", "coord_z"),
           ("ship_motor_temp_c", "motor_temp_c"), ("ship_engine_pressure_kpa", "engine_pressure_kpa"),
           ("ship_power_core_temp_c", "power_core_temp_c"), ("ship_navigation_signal_db", "navigation_signal_db"),
           ("ship_distance_km", "distance"),
           ("ship_repair_flag", "CASE WHEN status = 'REPAIR' THEN 1.0 ELSE 0.0 END"),
           ("ship_mission_success", "CASE WHEN mission_status = 'SUCCESS' THEN 1.0 ELSE 0.0 END"),
           ("ship_mission_failure", "CASE WHEN mission_status = 'FAILURE' THEN 1.0 ELSE 0.0 END")]


def _gauge_sql(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS metric, ship_id, mission_id, CAST({value} AS DOUBLE) AS value FROM {source}" for name, value in _GAUGES
    )


_LAST_TICK = """tick AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ship_id, mission_id ORDER BY seq DESC) AS rn FROM telemetry) WHERE rn = 1)"""
_METRICS = Q.sql([Q.TELEMETRY, _LAST_TICK], _gauge_sql("tick"))


@query(_METRICS)
def telemetry_metrics_latest(b: Bound) -> DataFrame:
    return RS.latest_gauges(b.telemetry, "seq").drop("help")


@query(Q.sql([Q.TELEMETRY], _gauge_sql("telemetry")))
def telemetry_gauges(b: Bound) -> DataFrame:
    return RS.gauge_samples(b.telemetry).drop("help")


@query(_METRICS)
def metrics_upsert(b: Bound) -> DataFrame:
    """Gauges of the first half of the month, with the second half merged in."""
    later = b.telemetry.where(F.col("timestamp") >= MID_EV.replace(" ", "T"))
    return RS.merge_gauges(RS.latest_gauges(b.early_telemetry, "seq"), RS.latest_gauges(later, "seq")).drop("help")


@query(
    Q.sql(
        [Q.TELEMETRY],
        """SELECT mission_id, seq, mission_status AS status, "timestamp" AS ended_at FROM (
  SELECT *, row_number() OVER (PARTITION BY mission_id ORDER BY seq) AS rn FROM telemetry WHERE mission_status IS NOT NULL)
WHERE rn = 1""",
    )
)
def mission_outcomes(b: Bound) -> DataFrame:
    return RD.mission_outcomes(b.telemetry)


def _snapshots(as_of: str) -> list[str]:
    return [
        Q.MISSIONS,
        Q.TELEMETRY,
        f"seen AS (SELECT t.* FROM telemetry t JOIN missions m ON m.mission_id = t.mission WHERE ts <= {as_of})",
        "ends AS (SELECT mission, min(seq) AS end_seq FROM seen WHERE mission_status IS NOT NULL GROUP BY mission)",
        "firsts AS (SELECT mission, min(seq) AS seq FROM seen GROUP BY mission)",
        # Every report time up to the day of the run; what was known then is the latest tick before it.
        f"""times AS (
  SELECT mission_id AS mission, k AS report_no, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(k * report_freq_min * 6 AS INTEGER)) AS at
  FROM missions, range(1, 200) r(k)
  WHERE TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(k * report_freq_min * 6 AS INTEGER)) <= {as_of})""",
        """known AS (
  SELECT r.mission, r.report_no, max(t.seq) AS seq FROM times r JOIN seen t ON t.mission = r.mission
  AND date_trunc('second', t.ts) < r.at GROUP BY 1, 2)""",
        """picked AS (
  SELECT 0 AS report_no, 'start' AS report_kind, CASE status WHEN 'REPAIR' THEN 'REPAIR' ELSE 'OK' END AS reported, t.*
  FROM firsts f JOIN seen t ON t.seq = f.seq
  UNION ALL
  SELECT k.report_no, 'periodic', CASE status WHEN 'REPAIR' THEN 'REPAIR' ELSE 'OK' END, t.*
  FROM known k JOIN seen t ON t.seq = k.seq LEFT JOIN ends e ON e.mission = k.mission
  WHERE NOT EXISTS (SELECT 1 FROM times r JOIN seen x ON x.seq = e.end_seq
                    WHERE r.mission = k.mission AND r.report_no = k.report_no AND date_trunc('second', x.ts) < r.at)
  UNION ALL
  SELECT (SELECT count(*) FROM range(1, 200) r(k) WHERE TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(k * report_freq_min * 6 AS INTEGER))
          <= date_trunc('second', t.ts)) + 1, 'final', mission_status, t.*
  FROM seen t JOIN ends e ON e.mission = t.mission AND e.end_seq = t.seq JOIN missions m ON m.mission_id = t.mission)""",
        "reported AS (SELECT * REPLACE (reported AS status) FROM picked)",
        Q.scored("snap", "reported", "false"),
    ]


_SNAPSHOT_COLUMNS = """SELECT mission AS mission_id, report_no, report_kind AS kind, "timestamp", ship_id, status, fuel_prc,
  health AS normalized_health_total, ship_condition FROM snap"""


@query(Q.sql(_snapshots(f"TIMESTAMP '{AS_OF_EV}'"), _SNAPSHOT_COLUMNS))
def report_snapshots(b: Bound) -> DataFrame:
    anchor = TM.instant(ANCHOR_EV)
    snaps = RP.report_snapshots(b.missions, b.telemetry, AS_OF_EV, "seq", F.col("report_freq_min") * 6 * 3600, anchor)
    return _reported(snaps)


def _reported(snaps: DataFrame) -> DataFrame:
    return snaps.select(
        "mission_id", "report_no", "kind", "timestamp", "ship_id", "status", "fuel_prc", "normalized_health_total", "ship_condition"
    )


# --- gates and data quality --------------------------------------------------------------------------------------


@query(
    Q.sql(
        [Q.MISSIONS],
        f"""SELECT 'open' AS gate, count(*) > 0 AS should_run, count(*) AS n FROM missions
WHERE coalesce(finished_at, started_at) > {Q.T1} - INTERVAL '90' DAY
UNION ALL SELECT 'closed', count(*) > 0, count(*) FROM missions
WHERE coalesce(finished_at, started_at) > TIMESTAMP '2010-01-01 00:00:00' - INTERVAL '30' MINUTE""",
    )
)
def gate_recent_missions(b: Bound) -> DataFrame:
    wide = G.missions_gate(b.missions, T1, timedelta(days=90))
    narrow = G.missions_gate(b.missions, "2010-01-01 00:00:00")
    return wide.select(F.lit("open").alias("gate"), "*").unionAll(narrow.select(F.lit("closed").alias("gate"), "*"))


@query(
    Q.sql(
        [Q.MANIFESTS],
        f"""SELECT 'open' AS gate, count(*) > 0 AS should_run, count(*) AS n FROM manifests WHERE upload_time > {Q.T1} - INTERVAL '90' DAY
UNION ALL SELECT 'closed', count(*) > 0, count(*) FROM manifests
WHERE upload_time > TIMESTAMP '2010-01-01 00:00:00' - INTERVAL '15' MINUTE""",
    )
)
def gate_recent_manifests(b: Bound) -> DataFrame:
    wide = G.manifests_gate(b.manifests, T1, timedelta(days=90))
    narrow = G.manifests_gate(b.manifests, "2010-01-01 00:00:00")
    return wide.select(F.lit("open").alias("gate"), "*").unionAll(narrow.select(F.lit("closed").alias("gate"), "*"))


_DQ = "SELECT '{table}' AS \"table\", '{check}' AS \"check\", {key} AS key, {n} AS n"


@query(
    Q.sql(
        [Q.MANIFESTS, Q.MISSIONS, Q.TELEMETRY],
        """SELECT 'lineitem' AS "table", 'primary_key' AS "check", l_orderkey || '|' || l_linenumber AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'missions', 'primary_key', CAST(mission_id AS VARCHAR), count(*) FROM missions GROUP BY mission_id HAVING count(*) > 1
UNION ALL SELECT 'manifests', 'primary_key', mission_id || '|' || strftime(mission_date, '%Y-%m-%d'), count(*) FROM manifests
GROUP BY mission_id, mission_date HAVING count(*) > 1
UNION ALL SELECT 'ship_state', 'primary_key', mission || '|' || ts, count(*) FROM telemetry GROUP BY mission, ts HAVING count(*) > 1""",
    )
)
def dq_pk_duplicates(b: Bound) -> DataFrame:
    lines = DQ.primary_key(b.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    missions = DQ.primary_key(b.missions, "missions", ["mission_id"])
    manifests = DQ.primary_key(b.manifests, "manifests", ["mission_id", "mission_date"])
    ticks = DQ.primary_key(b.ship_state, "ship_state", ["mission_id", "timestamp"])
    return lines.unionAll(missions).unionAll(manifests).unionAll(ticks)


_LIVE = "live AS (SELECT * FROM missions WHERE status <> 'FAILURE')"


@query(
    Q.sql(
        [Q.MISSIONS, _LIVE, Q.TELEMETRY, Q.REPORTS, Q.MANIFESTS],
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS "table", 'foreign_key' AS "check", CAST({key} AS VARCHAR) AS key, count(*) AS n FROM {source}
WHERE {key} NOT IN (SELECT mission_id FROM live) GROUP BY {key}"""
            for name, source, key in (("ship_state", "telemetry", "mission"), ("mission_reports", "reports", "mission_id"), ("manifests", "manifests", "mission_id"))
        ),
    )
)
def dq_fk_orphans(b: Bound) -> DataFrame:
    live = b.live_missions
    states = DQ.foreign_key(b.ship_state, live, "ship_state", "mission_id")
    reports = DQ.foreign_key(b.mission_reports, live, "mission_reports", "mission_id")
    return states.unionAll(reports).unionAll(DQ.foreign_key(b.manifests, live, "manifests", "mission_id"))


@query(
    Q.sql(
        [Q.MISSIONS, Q.TELEMETRY],
        """SELECT 'missions' AS "table", 'not_null' AS "check", 'finished_at' AS key, count(*) AS n FROM missions WHERE finished_at IS NULL
UNION ALL SELECT 'telemetry', 'not_null', 'mission_status', count(*) FROM telemetry WHERE mission_status IS NULL""",
    )
)
def dq_nulls(b: Bound) -> DataFrame:
    missions = DQ.not_null(b.missions, "missions", ["ship_name", "captain", "target", "report_freq_min", "finished_at"])
    return missions.unionAll(DQ.not_null(b.telemetry, "telemetry", ["ship_id", "mission_status"]))


@query(
    """SELECT 'lineitem' AS "table", 'numeric_overflow' AS "check", key, n FROM (
  SELECT 'fuel_prc' AS key, count(*) AS n FROM lineitem WHERE TRY_CAST(l_extendedprice / 50 AS DECIMAL(5, 2)) IS NULL
  UNION ALL SELECT 'temperature_C', count(*) FROM lineitem WHERE TRY_CAST(l_extendedprice / 4 AS DECIMAL(5, 1)) IS NULL
  UNION ALL SELECT 'radiation_uSv', count(*) FROM lineitem WHERE TRY_CAST(l_extendedprice AS DECIMAL(8, 3)) IS NULL) WHERE n > 0"""
)
def dq_numeric_overflow(b: Bound) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = b.table("lineitem").select(
        (price / 50).alias("fuel_prc"), (price / 4).alias("temperature_C"), price.alias("radiation_uSv"), price.alias("coord_x")
    )
    return DQ.numeric_overflow(rows, "lineitem", SHIP_STATE)


@query(
    Q.sql(
        [Q.REPORTS],
        """SELECT 'mission_reports' AS "table", 'text_width' AS "check", 'item' AS key, count(*) AS n FROM reports
WHERE length(item) > 9 OR length(item) < 8 HAVING count(*) > 0""",
    )
)
def dq_text_width(b: Bound) -> DataFrame:
    items = DQ.text_width(b.mission_reports, "mission_reports", {"item": (8, 9)})
    return items.unionAll(DQ.text_width(b.manifests, "manifests"))


@query(
    Q.sql(
        [Q.TELEMETRY],
        """SELECT 'ship_state' AS "table", 'status_domain' AS "check", status AS key, count(*) AS n FROM telemetry
WHERE status NOT IN ('RUNNING', 'SUCCESS', 'FAILURE') GROUP BY status""",
    )
)
def dq_status_domain(b: Bound) -> DataFrame:
    """Missions keep to their states; ticks, held to mission states on purpose, do not."""
    missions = DQ.status_domain(b.missions, "missions")
    return missions.unionAll(DQ.status_domain(b.ship_state, "ship_state"))


@query(Q.sql([Q.MISSIONS], """SELECT 'captains' AS "table", 'single_row' AS "check", 'rows' AS key, count(DISTINCT captain) AS n FROM missions"""))
def dq_single_row_mart(b: Bound) -> DataFrame:
    operations, cargo = _mart_inputs(b)
    fleet = DQ.single_row(S.mart_fleet_kpis(operations, cargo, AS_OF), "fleet")
    return fleet.unionAll(DQ.single_row(S.mart_captain_performance(operations, cargo, AS_OF), "captains"))


def _digests(name: str, value: str, rows: str) -> list[str]:
    """CTEs giving (mission_id, day, checksum) of report rows: the parts of the rows' hashes added up, and hashed."""
    sums = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))
    return [
        f"""{name}_row AS (
  SELECT mission_id, CAST(seen AS DATE) AS day, sha256(item || '|' || CAST(CAST({value} AS DECIMAL(38, 9)) AS VARCHAR) || '|'
         || strftime(seen, '%Y-%m-%d %H:%M:%S')) AS h FROM {rows})""",
        f"{name} AS (SELECT mission_id, day, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {sums})) AS checksum FROM {name}_row GROUP BY 1, 2)",
    ]


@query(
    Q.sql(
        [
            Q.REPORTS,
            Q.MANIFESTS,
            *_digests("sent", "value", "reports"),
            *_digests("kept", "value + CASE WHEN mission_id % 97 = 5 THEN 1 ELSE 0 END", "(SELECT * FROM reports WHERE mission_id % 97 <> 6)"),
        ],
        """SELECT 'manifests' AS "table", 'checksum' AS "check", mission_file AS key, 1::BIGINT AS n
FROM manifests m JOIN sent s ON s.mission_id = m.mission_id AND s.day = m.mission_date
LEFT JOIN kept k ON k.mission_id = s.mission_id AND k.day = s.day
WHERE k.checksum IS DISTINCT FROM s.checksum""",
    )
)
def dq_checksum_mismatch(b: Bound) -> DataFrame:
    """Manifests hold the checksums of the rows that were sent; what is stored was written without some missions and
    written again with other values for some."""
    path, mission = work_path(b.spark, "objects"), F.col("mission_id").cast("bigint")
    sent = b.report_rows.drop("object_key")
    SF.export_reports(sent.where(mission % 97 != 6), path, 0, "runs")
    SF.export_reports(sent.where(mission % 97 == 5).withColumn("value", F.col("value") + 1), path, 1, "runs")
    manifests = RP.report_objects(sent).select(F.col("object_key").alias("mission_file"), F.col("checksum").alias("checksum_mission"), "object")
    return DQ.checksum_mismatch(manifests, RP.report_objects(newest_run(RP.with_object(read_report_rows(b.spark, path)), "object")))


@query(
    Q.sql(
        [Q.MISSIONS, _LIVE, Q.REPORTS],
        f"""SELECT mission_id, item, {Q.num('value', 6)} AS value, {Q.ts('seen')} AS "timestamp" FROM reports
WHERE mission_id IN (SELECT mission_id FROM live)""",
    )
)
def cascade_prune(b: Bound) -> DataFrame:
    return present(K.cascade(b.mission_reports, b.live_missions, "mission_id").select("mission_id", "item", "value", "timestamp"))


# --- streams: the events table drained through each streaming job --------------------------------------------------


def _event_stream(b: Bound) -> DataFrame:
    """Events as they arrive, dealt out by number: few tasks read a file, and records are made and parsed in all of them."""
    schema: T.StructType = b.table("events").schema
    events = b.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(b.dir)
    return events_as_records(events.repartition("event_id"))


@query(Q.sql([Q.TELEMETRY], _WIRE))
def stream_lake(b: Bound) -> DataFrame:
    root = work_path(b.spark, "lake")
    J.run_lake(_event_stream(b), f"{root}/lake", f"{root}/checkpoint", J.DRAIN).awaitTermination()
    return read_lake(b.spark, f"{root}/lake").drop("batch_id", "mission_bucket").withColumnRenamed(C.ORIGIN_DISTANCE, "distance")


@query(Q.sql([Q.TELEMETRY], _WIRE))
def stored_lake(b: Bound) -> DataFrame:
    """A lake by day: the stream and two more batches, one of them written twice, closed days rewritten, a late batch."""
    root = work_path(b.spark, "days")
    lake = DayLake(b.spark, f"{root}/lake")
    arrived = J.arriving(b.topic_records)
    third = F.col("seq") % 3
    lake.write(arrived.where(third == 0), 0)
    for _ in range(2):
        lake.write(arrived.where((third == 1) & (F.col("seq") % 11 > 0)), 1)
    lake.compact("2024-01-20", 1)
    lake.write(arrived.where((third == 2) | ((third == 1) & (F.col("seq") % 11 == 0))), 2)
    lake.compact("2024-01-10", 2)
    return lake.read().withColumnRenamed(C.ORIGIN_DISTANCE, "distance")


@query(
    Q.sql(
        [Q.MISSIONS, Q.REPORTS],
        """SELECT captain, 'ships' AS kind, strftime(date_trunc('quarter', started_at), '%Y-%m') AS quarter, count(DISTINCT ship_name) AS n
FROM missions GROUP BY ALL
UNION ALL SELECT captain, 'items', strftime(date_trunc('quarter', seen), '%Y-%m'), count(DISTINCT item)
FROM reports JOIN missions USING (mission_id) GROUP BY ALL
UNION ALL SELECT captain, 'missions', 'all', count(DISTINCT mission_id) FROM reports JOIN missions USING (mission_id) GROUP BY ALL""",
    )
)
def distinct_by_period(b: Bound) -> DataFrame:
    """Ships and items by captain and quarter, reporting missions over all years, from stored bitmaps of every month."""
    root = work_path(b.spark, "bitmaps")
    ships, items = D.numbered(b.missions, "ship_name"), D.numbered(b.mission_reports, "item")
    reports = b.mission_reports.join(b.missions.select("mission_id", "captain"), "mission_id")
    for kind, rows, at, number in (
        ("ships", b.missions.join(ships, "ship_name"), "started_at", "number"),
        ("items", reports.join(items, "item"), "timestamp", "number"),
        ("missions", reports, "timestamp", "mission_id"),
    ):
        month = F.date_format(at, "yyyy-MM").alias("month")
        D.distinct_partials(rows.select("captain", month, F.col(number)), ["captain", "month"], F.col(number)).write.parquet(f"{root}/{kind}")

    def counted(kind: str, period: Column) -> DataFrame:
        partials = b.spark.read.parquet(f"{root}/{kind}").withColumn("quarter", period)
        return D.distinct_counts(partials, ["captain", "quarter"]).select("captain", F.lit(kind).alias("kind"), "quarter", "n")

    quarter = F.date_format(F.date_trunc("quarter", F.to_date("month", "yyyy-MM")), "yyyy-MM")
    return counted("ships", quarter).union(counted("items", quarter)).union(counted("missions", F.lit("all")))


@query(_METRICS)
def stream_metrics(b: Bound) -> DataFrame:
    root = work_path(b.spark, "metrics")
    metrics = J.metrics_table(b.spark, f"{root}/gauges")
    J.run_metrics(_event_stream(b), metrics, f"{root}/checkpoint", J.DRAIN).awaitTermination()
    return metrics.read().drop("help")


@query(Q.sql([Q.TELEMETRY, _RADAR], _RADAR_OUT))
def stream_radar_latest(b: Bound) -> DataFrame:
    root = work_path(b.spark, "radar")
    store = TableStore(b.spark, f"{root}/tables")
    J.run_radar(_event_stream(b), store, f"{root}/checkpoint", J.DRAIN).awaitTermination()
    return _radar_columns(store.read("radar_latest"))


@query(_TRANSITIONS)
def stream_radar_transitions(b: Bound) -> DataFrame:
    root = work_path(b.spark, "transitions")
    J.run_transitions(_event_stream(b), f"{root}/log", f"{root}/checkpoint", J.DRAIN).awaitTermination()
    return b.spark.read.parquet(f"{root}/log").drop("batch_id")


@query(Q.sql(_snapshots("(SELECT max(ts) FROM telemetry)"), _SNAPSHOT_COLUMNS))
def stream_reports(b: Bound) -> DataFrame:
    """Reports that fell due while the events went by: the last event is the clock."""
    root, anchor = work_path(b.spark, "due"), TM.instant(ANCHOR_EV)
    period = F.col("report_freq_min") * 6 * 3600
    J.run_reports(_event_stream(b), b.missions, f"{root}/reports", f"{root}/checkpoint", J.DRAIN, period, anchor).awaitTermination()
    return _reported(b.spark.read.parquet(f"{root}/reports").drop("batch_id"))


# --- what is written and read back -------------------------------------------------------------------------------


@query(
    Q.sql(
        [Q.REPORTS, Q.MANIFESTS],
        f"""SELECT CAST(r.mission_id AS VARCHAR) AS mission_id, item, {Q.num('value')} AS value, {Q.ts('seen')} AS "timestamp", mission_file AS object_key
FROM reports r JOIN manifests n ON n.mission_id = r.mission_id AND n.mission_date = CAST(r.seen AS DATE)""",
    )
)
def stored_reports(b: Bound) -> DataFrame:
    """Report rows by day and run, with the key of their object."""
    path, rows = work_path(b.spark, "reports"), b.report_rows.drop("object_key")
    SF.export_reports(rows, path, 0)
    return read_report_rows(b.spark, path).select("mission_id", "item", "value", "timestamp", "object_key")


@query(Q.sql([Q.MANIFESTS], "SELECT manifest_path, checksum_mission AS checksum FROM manifests"))
def stored_manifests(b: Bound) -> DataFrame:
    """Manifest documents of two runs; of each path the newer one is read."""
    path, documents = work_path(b.spark, "documents"), _documents(b)
    SF.write_manifest_documents(documents.withColumn("text", F.lit("{}")), path, 0)
    SF.write_manifest_documents(documents, path, 1)
    got = read_manifest_rows(b.spark, path)
    return got.select("manifest_path", F.get_json_object("text", "$.checksum.mission").alias("checksum"))


@query(
    """SELECT c_nationkey::BIGINT AS nation, sum(length(c_name) + 1)::BIGINT AS length,
  sha256(string_agg(c_name, chr(10) ORDER BY c_name) || chr(10)) AS sha256 FROM customer GROUP BY 1"""
)
def exported_hashes(b: Bound) -> DataFrame:
    """SHA-256 of the bytes of written files: one text file a nation with the names of its customers."""
    path = work_path(b.spark, "names")
    names = b.table("customer").select("c_name", "c_nationkey").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_name")
    names.write.partitionBy("c_nationkey").text(path)
    nation = F.regexp_extract("object_key", r"c_nationkey=(\d+)/", 1).cast("bigint")
    return file_hashes(b.spark, path, "*.txt").select(nation.alias("nation"), "length", "sha256")


@query(Q.sql([Q.TELEMETRY], "SELECT count(*) AS counted, count(*) AS stored FROM telemetry"))
def counted_lake_write(b: Bound) -> DataFrame:
    """Rows of a lake batch as counted while it was written, beside those that are there."""
    path, counter = work_path(b.spark, "lake"), Observation("lake")
    write_lake(J.arriving(b.topic_records), 0, path, counter=counter)
    there = read_lake(b.spark, path).agg(F.count(F.lit(1)).alias("stored"))
    return there.select(F.lit(counter.get["rows"]).cast("bigint").alias("counted"), "stored")


@query(
    Q.sql(
        [Q.REPORTS, Q.MANIFESTS],
        """SELECT n.mission_id, strftime(mission_date, '%Y-%m-%d') AS mission_date, manifest_path, checksum_mission, count(*) AS n
FROM manifests n JOIN reports r ON n.mission_id = r.mission_id AND n.mission_date = CAST(r.seen AS DATE) GROUP BY ALL""",
    )
)
def stream_ingest(b: Bound) -> DataFrame:
    """Two runs over documents that arrive in two lots. The first run has the reports before 1996 only; the second takes
    up what waited since, and the second lot."""
    root, documents = work_path(b.spark, "ingest"), _documents(b)
    day = F.element_at(F.split("manifest_path", "/"), 2)
    lots = (documents.where(day < T1[:10]), documents.where(day >= T1[:10]))
    reports = (b.report_rows.where(F.col("timestamp") < "1996-01-01"), b.report_rows)
    for number, (lot, arrived) in enumerate(zip(lots, reports)):
        SF.write_manifest_documents(lot, f"{root}/documents", number)
        source = stream_manifest_rows(b.spark, f"{root}/documents")
        J.run_ingest(source, lambda rows=arrived: rows, f"{root}/landing", f"{root}/position", lambda: AS_OF).awaitTermination()
    landed = read_landing(b.spark, f"{root}/landing", "mission_reports", MISSION_REPORTS).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    manifests = read_landing(b.spark, f"{root}/landing", "manifests", MANIFESTS)
    both = manifests.join(landed, manifests["mission_file"] == landed["source_file"])
    return present(both.select("mission_id", "mission_date", "manifest_path", "checksum_mission", "n"))


@query(ORACLES["clean_reports"])
def stored_logs(b: Bound) -> DataFrame:
    """Raw logs as CSV, written twice by one run, read by column names and cleaned."""
    path, parts = work_path(b.spark, "logs"), b.table("part").select("p_partkey", F.col("p_name").alias("item"))
    raw = b.table("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("mission_id"),
        "item",
        F.col("l_quantity").cast("string").alias("value"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    for _ in range(2):
        SF.write_raw_logs(raw, path, 0)
    return I.clean_reports(read_mission_logs(b.spark, path).select("mission_id", "item", "value", "timestamp"))


@query(ORACLES["audit_log"])
def stored_audit_log(b: Bound) -> DataFrame:
    path, events = work_path(b.spark, "audit"), audit_log(b)
    for _ in range(2):
        SF.write_audit_log(events, path, run_id=0)
    names = events.columns
    return b.spark.read.json(path).withColumn("log_date", F.col("log_date").cast("string")).select(*names)


@query(ORACLES["manifest_registration"])
def stored_landing(b: Bound) -> DataFrame:
    """An ingest run appended twice under its number, and read over all runs."""
    root = work_path(b.spark, "landing")
    for _ in range(2):
        append_landing(_landing(b, keep=True), root, 1)
    reports = read_landing(b.spark, root, "mission_reports", MISSION_REPORTS)
    manifests = read_landing(b.spark, root, "manifests", MANIFESTS)
    landed = ingested_only(reports, manifests).select("source_file").distinct()
    seen = manifests.join(landed, manifests["mission_file"] == landed["source_file"], "left_semi")
    return present(seen.drop("checksum_manifest"))


@query(ORACLES["upsert_cargo_summary"])
def stored_refresh(b: Bound) -> DataFrame:
    """Summaries as of T1 stored by bucket, refreshed there by one gated run."""
    early = RF.bl_rebuild(b.early_missions, b.early_ship_state, _early_reports(b), b.early_manifests, T1, keep=True)
    tables = RF.store_summaries(b.spark, work_path(b.spark, "bl"), early, buckets=16)
    sources = {"missions": b.missions, "ship_state": b.ship_state, "mission_reports": b.mission_reports, "manifests": b.manifests}
    RF.run_bl_refresh(tables, sources, AS_OF, 1, timedelta(days=36500))
    return present(tables["cargo_summary"].read())


def _kept_marts(b: Bound) -> dict[str, DataFrame]:
    """Marts built as of T1 and kept up through three runs, each with the missions that changed."""
    early = RF.bl_rebuild(b.early_missions, b.early_ship_state, _early_reports(b), b.early_manifests, T1)
    kept = S.KeptMarts.build(b.spark, work_path(b.spark, "marts"), S.mission_facts(early["mission_summary"], early["cargo_summary"]), 8)
    operations, cargo = _mart_inputs(b)
    facts = stored(S.mission_facts(operations, cargo), "facts")
    for version in (1, 2, 3):
        kept.update(facts.where(F.col("mission_id") % 3 == version - 1), version)
    return kept.marts(B.planet_summary(b.missions, operations, cargo, AS_OF), AS_OF)


@query(ORACLES["mart_ship_performance"])
def kept_mart_ships(b: Bound) -> DataFrame:
    return present(_kept_marts(b)["mart_ship_performance"])


@query(ORACLES["mart_captain_performance"])
def kept_mart_captains(b: Bound) -> DataFrame:
    return present(_kept_marts(b)["mart_captain_performance"])


@query(ORACLES["mart_ship_performance"])
def stored_mart(b: Bound) -> DataFrame:
    """The ship leaderboard stored in rank order."""
    path = work_path(b.spark, "mart")
    SF.write_sorted(S.mart_ship_performance(*_mart_inputs(b), AS_OF), path, F.desc_nulls_first("total_value_poko"), "ship_name")
    return present(b.spark.read.parquet(path))


_BOARDS = (
    ("ship", "mart_ship_performance", "ship_name", "total_value_poko"),
    ("captain", "mart_captain_performance", "captain", "total_value_poko"),
    ("destination", "mart_planet_performance", "planet_name", "nb_missions_total"),
)


@query(
    " UNION ALL ".join(
        f"SELECT '{board}' AS board, row_number() OVER (ORDER BY {by} DESC NULLS FIRST, {name}) AS rank, {name} AS name FROM ({ORACLES[mart]})"
        for board, mart, name, by in _BOARDS
    )
)
def leaderboards(b: Bound) -> DataFrame:
    """The three leaderboards with the place of every ship, captain and destination as a column."""
    operations, cargo = _mart_inputs(b)
    places = B.planet_summary(b.missions, operations, cargo, AS_OF)
    marts = (
        S.mart_ship_performance(operations, cargo, AS_OF),
        S.mart_captain_performance(operations, cargo, AS_OF),
        S.mart_planet_performance(places, operations, cargo, AS_OF),
    )
    boards = [
        A.ranked(mart, F.desc_nulls_first(by), F.col(name)).select(F.lit(board).alias("board"), "rank", F.col(name).alias("name"))
        for mart, (board, _, name, by) in zip(marts, _BOARDS)
    ]
    return reduce(DataFrame.unionAll, boards)
