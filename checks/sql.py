"""SQL building blocks of the oracles: the bound tables and the summaries, as CTEs for DuckDB."""

from __future__ import annotations

from wakeline import catalogue as C

AS_OF, T1, MID_EV = "TIMESTAMP '2002-01-01 00:00:00'", "TIMESTAMP '1998-07-01 00:00:00'", "TIMESTAMP '2024-01-16 00:00:00'"


def round_binary(x: str, digits: int) -> str:
    """Round the non-negative double column ``x`` on its binary value, ties to even."""
    s = f"{10**digits}::DOUBLE"
    hi = f"({x} * 134217729::DOUBLE - ({x} * 134217729::DOUBLE - {x}))"
    lo = f"({x} - {hi})"
    whole = f"floor({hi} * {s} + {lo} * {s})"
    beyond = f"(({hi} * {s} - {whole} - 0.5::DOUBLE) + {lo} * {s})"
    return (
        f"((CASE WHEN {beyond} > 0 OR ({beyond} = 0 AND {whole}::BIGINT % 2 = 1) THEN {whole} + 1 ELSE {whole} END) / {s})"
    )


def dec(x: str, p: int, s: int) -> str:
    """Double to decimal on its shortest text, half away from zero."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL({p},{s}))"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def num(x: str, digits: int = 9) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits})"


def numeric(x: str, digits: int) -> str:
    """Round as SQL rounds a NUMERIC: half away from zero on the decimal value, free of binary noise below 1e-12."""
    return f"CAST(round(CAST({x} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def band(x: str, centre: float) -> str:
    return f"greatest(0::DOUBLE, least(1::DOUBLE, 1::DOUBLE - abs({x} - {centre}::DOUBLE) / {centre}::DOUBLE))"


MISSIONS = """
missions AS (
  SELECT o_orderkey AS mission_id,
         'SS_' || lpad(CAST(o_orderkey % 23 AS VARCHAR), 2, '0') AS ship_name,
         'CPT_' || lpad(CAST(o_custkey % 21 AS VARCHAR), 2, '0') AS captain,
         n_name AS target,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS report_freq_min,
         CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'P' THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + (1 + o_orderkey % 120) * INTERVAL '1' DAY END AS finished_at
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
)"""

EARLY_MISSIONS = f"""
early_missions AS (
  SELECT mission_id, ship_name, captain, target, report_freq_min,
         CASE WHEN finished_at >= {T1} THEN 'RUNNING' ELSE status END AS status, started_at,
         CASE WHEN finished_at < {T1} THEN finished_at END AS finished_at
  FROM missions WHERE started_at < {T1}
)"""

TELEMETRY = """
bound AS (
  SELECT event_id AS seq, ts, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         user_id * 100 + event_id % 20 AS mission
  FROM events
), telemetry AS (
  SELECT seq, ts, mission, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         CAST(mission AS VARCHAR) AS mission_id,
         'SS_' || lpad(CAST(mission % 23 AS VARCHAR), 2, '0') AS ship_id,
         k * 1.0e6 AS coord_x, value * 1.0e6 AS coord_y, -k * 0.5e6 AS coord_z,
         CAST(k AS DOUBLE) AS fuel_prc, 25::DOUBLE + value / 2 AS motor_temp_c,
         90::DOUBLE + value * 1.8::DOUBLE AS engine_pressure_kpa, 290::DOUBLE + value * 2 AS power_core_temp_c,
         -100::DOUBLE + k / 2::DOUBLE AS navigation_signal_db,
         sqrt((k * 1.0e6) * (k * 1.0e6) + (value * 1.0e6) * (value * 1.0e6) + (-k * 0.5e6) * (-k * 0.5e6)) AS distance,
         CASE WHEN kind = 'error' THEN 'REPAIR' WHEN kind = 'signup' AND k < 20 THEN 'FAILURE' ELSE 'OK' END AS status,
         CASE WHEN kind = 'signup' AND k < 20 THEN 'FAILURE' WHEN kind = 'purchase' AND k >= 90 THEN 'SUCCESS' END AS mission_status,
         CASE WHEN kind = 'click' AND k >= 80 THEN 'motor_temp_c' END AS malfunctioned_component,
         CASE WHEN kind = 'view' THEN value / 50 END AS radiation,
         CASE WHEN kind = 'click' THEN 100::DOUBLE - k / 10::DOUBLE END AS integrity
  FROM bound
)"""

# Scoring of any relation with the telemetry columns.
def scored(name: str, source: str, malfunction: str = "coalesce(malfunctioned_component, '') <> ''") -> str:
    return f"""
{name}_parts AS (
  SELECT *, {band('motor_temp_c', 90)} AS m, {band('engine_pressure_kpa', 325)} AS e,
         {band('power_core_temp_c', 600)} AS c, greatest(0::DOUBLE, least(1::DOUBLE, fuel_prc / 100)) AS f,
         motor_temp_c < 30 OR motor_temp_c > 180 OR engine_pressure_kpa < 100 OR engine_pressure_kpa > 600
           OR power_core_temp_c < 300 OR power_core_temp_c > 950 OR fuel_prc <= 5 AS broken,
         {malfunction} AS malfunction
  FROM {source}
), {name}_total AS (
  SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, 0.3::DOUBLE * m + 0.3::DOUBLE * e + 0.3::DOUBLE * c + 0.1::DOUBLE * f)) AS total
  FROM {name}_parts
), {name}_capped AS (
  SELECT *, CASE WHEN status = 'REPAIR' THEN least(total, 0.4::DOUBLE) WHEN status = 'FAILURE' THEN 0::DOUBLE
                 WHEN malfunction AND NOT broken THEN least(total, 0.3::DOUBLE) ELSE total END AS capped
  FROM {name}_total
), {name} AS (
  SELECT *, {round_binary('m', 3)} AS motor_health, {round_binary('e', 3)} AS engine_health,
         {round_binary('c', 3)} AS core_health, {round_binary('f', 3)} AS fuel_health,
         {round_binary('capped', 3)} AS health,
         CASE WHEN status = 'REPAIR' THEN 'REPAIRING'
              WHEN status = 'FAILURE' OR broken OR malfunction THEN 'UNOPERATIONAL'
              WHEN total >= 0.8 THEN 'GOOD' WHEN total >= 0.5 THEN 'MID' WHEN total >= 0.3 THEN 'BAD'
              ELSE 'CRITICAL' END AS ship_condition
  FROM {name}_capped
)"""


LANDING = f"""
landing AS (
  SELECT seq, mission AS mission_id, ts, status, ship_condition, {dec('health', 4, 3)} AS health,
         {dec('motor_health', 4, 3)} AS motor_health, {dec('engine_health', 4, 3)} AS engine_health,
         {dec('core_health', 4, 3)} AS core_health, {dec('fuel_health', 4, 3)} AS fuel_health,
         {dec('fuel_prc', 5, 2)} AS fuel, {dec('motor_temp_c', 5, 1)} AS temp,
         {dec('coalesce(radiation, 0)', 8, 3)} AS radiation, {dec('coalesce(integrity, 100)', 5, 2)} AS integrity,
         CAST(round(coord_x) AS BIGINT) AS coord_x, CAST(round(coord_y) AS BIGINT) AS coord_y,
         CAST(round(coord_z) AS BIGINT) AS coord_z
  FROM scored
)"""

REPORTS = """
reports AS (
  SELECT l_orderkey AS mission_id, p_name AS item, CAST(l_extendedprice AS DECIMAL(18, 2)) AS value, l_shipdate AS seen
  FROM lineitem JOIN part ON p_partkey = l_partkey
)"""

MANIFESTS = """
manifests AS (
  SELECT *, sha256(mission_file) AS checksum_mission, sha256(manifest_path) AS checksum_manifest FROM (
    SELECT mission_id, mission_date, upload_time,
           mission_id || '/' || strftime(mission_date, '%Y-%m-%d') || '/mission_' || mission_id || '_' || strftime(mission_date, '%Y%m%d') || '.parquet' AS mission_file,
           mission_id || '/' || strftime(mission_date, '%Y-%m-%d') || '/manifest_' || mission_id || '_' || strftime(mission_date, '%Y%m%d') || '.json' AS manifest_path
    FROM (SELECT l_orderkey AS mission_id, CAST(l_shipdate AS DATE) AS mission_date,
                 max(l_shipdate) + INTERVAL '18' HOUR AS upload_time
          FROM lineitem GROUP BY 1, 2)))"""


def mission_bl(name: str, missions: str, ticks: str, as_of: str) -> str:
    return f"""
{name} AS (
  SELECT m.mission_id, m.ship_name, m.captain, m.target, m.report_freq_min, m.status, m.started_at, m.finished_at,
         epoch(coalesce(m.finished_at, {as_of}) - m.started_at) / 3600.0 AS mission_duration_hr,
         coalesce(n, 0) AS total_ticks, h / n AS avg_health, fuel AS min_fuel_prc, temp AS max_temp_c,
         r / n AS avg_radiation_usv, i / n AS avg_cargo_int_prc, coalesce(good / n, 0) AS uptime_ratio,
         {as_of} AS computed_at
  FROM {missions} m LEFT JOIN (
    SELECT mission_id, count(*) AS n, CAST(sum(health) AS DOUBLE) AS h, min(fuel) AS fuel, max(temp) AS temp,
           CAST(sum(radiation) AS DOUBLE) AS r, CAST(sum(integrity) AS DOUBLE) AS i,
           count(*) FILTER (ship_condition = 'GOOD') AS good
    FROM {ticks} GROUP BY mission_id) t USING (mission_id)
)"""


def cargo_bl(name: str, missions: str, reports: str, as_of: str) -> str:
    return f"""
{name} AS (
  SELECT m.mission_id, m.ship_name, m.captain, m.target, coalesce(items, 0) AS nb_unique_items,
         total AS total_value_poko, CAST(total AS DOUBLE) / n AS avg_value, top AS max_item_value, {as_of} AS computed_at
  FROM {missions} m LEFT JOIN (
    SELECT mission_id, count(DISTINCT item) AS items, sum(value) AS total, count(value) AS n, max(value) AS top
    FROM {reports} GROUP BY mission_id) t USING (mission_id)
)"""


def manifest_bl(name: str, missions: str, manifests: str, as_of: str) -> str:
    return f"""
{name} AS (
  SELECT m.mission_id, m.ship_name, m.captain, m.target, coalesce(n, 0) AS nb_manifests,
         last_upload AS last_upload_time, CASE WHEN n > 0 THEN 'INGESTED' END AS last_status, {as_of} AS computed_at
  FROM {missions} m LEFT JOIN (
    SELECT mission_id, count(*) AS n, max(upload_time) AS last_upload FROM {manifests} GROUP BY mission_id) t
  USING (mission_id)
)"""


def planet_bl(name: str, missions: str, operations: str, cargo: str, as_of: str) -> str:
    return f"""
{name} AS (
  SELECT m.target AS planet, count(*) AS nb_missions,
         count(*) FILTER (m.status = 'SUCCESS') AS nb_success, count(*) FILTER (m.status = 'FAILURE') AS nb_failure,
         {numeric("100.0 * count(*) FILTER (m.status = 'SUCCESS') / count(*)", 1)} AS success_rate_pct,
         {numeric("avg(o.avg_health)", 3)} AS avg_health, {numeric("100 * avg(o.uptime_ratio)", 1)} AS avg_uptime_pct,
         {numeric("avg(c.total_value_poko)", 0)} AS avg_value_poko, {as_of} AS computed_at
  FROM {missions} m LEFT JOIN {operations} o USING (mission_id) LEFT JOIN {cargo} c USING (mission_id)
  GROUP BY m.target
)"""


EARLY_LANDING = f"early_landing AS (SELECT * FROM landing WHERE ts < {MID_EV})"
EARLY_REPORTS = f"early_reports AS (SELECT * FROM reports WHERE seen < {T1})"
EARLY_MANIFESTS = f"early_manifests AS (SELECT * FROM manifests WHERE mission_date < DATE '1998-07-01')"

SCORED = scored("scored", "telemetry")
TICKS = [TELEMETRY, SCORED, LANDING]
BL = [
    MISSIONS,
    *TICKS,
    REPORTS,
    MANIFESTS,
    mission_bl("operations", "missions", "landing", AS_OF),
    cargo_bl("cargo", "missions", "reports", AS_OF),
    manifest_bl("uploads", "missions", "manifests", AS_OF),
    planet_bl("planets", "missions", "operations", "cargo", AS_OF),
]

_MISSION_COLS = ["mission_id", "ship_name", "captain", "target", "report_freq_min", "status", "started_at", "finished_at",
                 "mission_duration_hr", "total_ticks", "avg_health", "min_fuel_prc", "max_temp_c", "avg_radiation_usv",
                 "avg_cargo_int_prc", "uptime_ratio", "computed_at"]
_CARGO_COLS = ["mission_id", "ship_name", "captain", "target", "nb_unique_items", "total_value_poko", "avg_value",
               "max_item_value", "computed_at"]
_UPLOAD_COLS = ["mission_id", "ship_name", "captain", "target", "nb_manifests", "last_upload_time", "last_status", "computed_at"]
_PLANET_COLS = ["planet", "nb_missions", "nb_success", "nb_failure", "success_rate_pct", "avg_health", "avg_uptime_pct",
                "avg_value_poko", "computed_at"]


def merged(name: str, old: str, new: str, key: str, columns: list[str], updated: list[str]) -> str:
    """Insert-or-update of ``new`` into ``old``: a known key takes only ``updated``."""
    picks = ", ".join(
        f"CASE WHEN {'n' if c in updated else 'o'}.{key} IS NOT NULL THEN {'n' if c in updated else 'o'}.{c} "
        f"ELSE {'o' if c in updated else 'n'}.{c} END AS {c}"
        for c in columns if c != key
    )
    return f"{name} AS (SELECT coalesce(o.{key}, n.{key}) AS {key}, {picks} FROM {old} o FULL JOIN {new} n ON o.{key} = n.{key})"


REFRESH = [
    MISSIONS,
    EARLY_MISSIONS,
    *TICKS,
    REPORTS,
    MANIFESTS,
    EARLY_LANDING,
    EARLY_REPORTS,
    EARLY_MANIFESTS,
    mission_bl("operations_1", "early_missions", "early_landing", T1),
    cargo_bl("cargo_1", "early_missions", "early_reports", T1),
    manifest_bl("uploads_1", "early_missions", "early_manifests", T1),
    planet_bl("planets_1", "early_missions", "operations_1", "cargo_1", T1),
    f"touched AS (SELECT * FROM missions WHERE coalesce(finished_at, started_at) > {T1} OR finished_at IS NULL)",
    f"due AS (SELECT * FROM missions WHERE {T1} < coalesce(finished_at, {AS_OF}))",
    mission_bl("operations_2", "touched", "landing", AS_OF),
    cargo_bl("cargo_2", "due", "reports", AS_OF),
    manifest_bl("uploads_all", "missions", "manifests", AS_OF),
    f"uploads_2 AS (SELECT * FROM uploads_all WHERE last_upload_time > {T1})",
    merged("operations", "operations_1", "operations_2", "mission_id", _MISSION_COLS,
           ["avg_health", "uptime_ratio", "min_fuel_prc", "max_temp_c", "computed_at"]),
    merged("cargo", "cargo_1", "cargo_2", "mission_id", _CARGO_COLS, _CARGO_COLS[4:]),
    merged("uploads", "uploads_1", "uploads_2", "mission_id", _UPLOAD_COLS, _UPLOAD_COLS[4:]),
    planet_bl("planets_2", "missions", "operations", "cargo", AS_OF),
    merged("planets", "planets_1", "planets_2", "planet", _PLANET_COLS, _PLANET_COLS[1:]),
]


def operations_out(source: str = "operations") -> str:
    return f"""SELECT mission_id, ship_name, captain, target, report_freq_min, status, {ts('started_at')} AS started_at,
       {ts('finished_at')} AS finished_at, {num('mission_duration_hr')} AS mission_duration_hr, total_ticks,
       {num('avg_health')} AS avg_health, {num('min_fuel_prc')} AS min_fuel_prc, {num('max_temp_c')} AS max_temp_c,
       {num('avg_radiation_usv')} AS avg_radiation_usv, {num('avg_cargo_int_prc')} AS avg_cargo_int_prc,
       {num('uptime_ratio')} AS uptime_ratio, {ts('computed_at')} AS computed_at FROM {source}"""


def cargo_out(source: str = "cargo") -> str:
    return f"""SELECT mission_id, ship_name, captain, target, nb_unique_items, {num('total_value_poko')} AS total_value_poko,
       {num('avg_value')} AS avg_value, {num('max_item_value')} AS max_item_value, {ts('computed_at')} AS computed_at
       FROM {source}"""


def uploads_out(source: str = "uploads") -> str:
    return f"""SELECT mission_id, ship_name, captain, target, nb_manifests, {ts('last_upload_time')} AS last_upload_time,
       last_status, {ts('computed_at')} AS computed_at FROM {source}"""


def planets_out(source: str = "planets") -> str:
    return f"""SELECT planet, nb_missions, nb_success, nb_failure, {num('success_rate_pct')} AS success_rate_pct,
       {num('avg_health')} AS avg_health, {num('avg_uptime_pct')} AS avg_uptime_pct,
       {num('avg_value_poko')} AS avg_value_poko, {ts('computed_at')} AS computed_at FROM {source}"""


def sql(ctes: list[str], body: str) -> str:
    """One statement out of the CTEs it needs and its body."""
    parts = [c.strip() for c in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def places() -> str:
    """The destination dimension with its position number, as the targets are bound to it by nation number."""
    rows = ", ".join(f"('{p}', {x!r}::DOUBLE, {y!r}::DOUBLE, {z!r}::DOUBLE)" for p, x, y, z in C.PLANETS)
    return f"places(planet, x, y, z) AS (VALUES {rows})"
