"""Domain tables derived from the driver's tables (FIXTURES.md section 3)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wakeline import catalogue as C
from wakeline.functions.health import score_health
from wakeline.functions.numeric import distance_from_origin
from wakeline.functions.text import manifest_key, report_key, sha256_hex
from wakeline.functions.times import instant
from wakeline.operators.arrival import latest_per_key
from wakeline.plans.ingest import telemetry_to_ship_state
from wakeline.plans.radar import is_terminal
from wakeline.schemas import DOUBLE, INT, LONG, TEXT, TIME, struct

AS_OF = "2002-01-01 00:00:00"
AS_OF_EV = "2024-02-01 00:00:00"
T1 = "1998-07-01 00:00:00"
MID_EV = "2024-01-16 00:00:00"
ANCHOR_EV = "2024-01-01 00:00:00"


# Declared, so that opening a table reads no footer.
TABLES = {
    "nation": struct(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": struct(c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT),
    "part": struct(p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=DOUBLE),
    "orders": struct(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DOUBLE, o_orderdate=TIME, o_orderpriority=TEXT
    ),
    "lineitem": struct(
        l_orderkey=LONG,
        l_partkey=LONG,
        l_suppkey=LONG,
        l_linenumber=INT,
        l_quantity=DOUBLE,
        l_extendedprice=DOUBLE,
        l_discount=DOUBLE,
        l_tax=DOUBLE,
        l_returnflag=TEXT,
        l_linestatus=TEXT,
        l_shipdate=TIME,
    ),
    "events": struct(event_id=LONG, ts=TIME, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT),
    "documents": struct(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
}


class Bound:
    """The domain tables over one data directory. Every property is a lazy plan, built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")
        return self._read[name]

    @cached_property
    def missions(self) -> DataFrame:
        places = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        orders = self.table("orders").join(
            places.select("c_custkey", F.col("n_name").alias("target")), F.col("o_custkey") == F.col("c_custkey")
        )
        done = F.col("o_orderstatus").isin("F", "P")
        days = F.make_dt_interval((1 + F.col("o_orderkey") % 120).cast("int"))
        finished = F.when(done, F.col("o_orderdate") + days)
        return orders.select(
            F.col("o_orderkey").alias("mission_id"),
            _padded("SS_", F.col("o_orderkey") % 23).alias("ship_name"),
            _padded("CPT_", F.col("o_custkey") % 21).alias("captain"),
            "target",
            F.substring("o_orderpriority", 1, 1).cast("int").alias("report_freq_min"),
            F.when(F.col("o_orderstatus") == "F", C.FAILURE)
            .when(F.col("o_orderstatus") == "P", C.SUCCESS)
            .otherwise(C.RUNNING)
            .alias("status"),
            F.col("o_orderdate").alias("started_at"),
            finished.alias("finished_at"),
            F.coalesce(finished, "o_orderdate").alias("updated_at"),
        )

    @cached_property
    def early_missions(self) -> DataFrame:
        """Missions as they stood at T1."""
        open_then = F.col("finished_at") >= instant(T1)
        finished = F.when(~open_then, F.col("finished_at"))
        return self.missions.where(F.col("started_at") < instant(T1)).withColumns(
            {
                "status": F.when(open_then, C.RUNNING).otherwise(F.col("status")),
                "finished_at": finished,
                "updated_at": F.coalesce(finished, "started_at"),
            }
        )

    @cached_property
    def live_missions(self) -> DataFrame:
        """Missions left after failed ones are removed from the registry."""
        return self.missions.where(F.col("status") != C.FAILURE)

    @cached_property
    def telemetry(self) -> DataFrame:
        return bind_events(self.table("events"))

    @cached_property
    def early_telemetry(self) -> DataFrame:
        return bind_events(self.table("events").where(F.col("ts") < instant(MID_EV)))

    @cached_property
    def ship_state(self) -> DataFrame:
        return to_ticks(self.telemetry)

    @cached_property
    def early_ship_state(self) -> DataFrame:
        return to_ticks(self.early_telemetry)

    @cached_property
    def mission_reports(self) -> DataFrame:
        items = self.table("part").select("p_partkey", F.col("p_name").alias("item"))
        lines = self.table("lineitem").join(items, F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.col("l_orderkey").alias("mission_id"),
            "item",
            F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
            F.col("l_shipdate").alias("timestamp"),
        )

    @cached_property
    def report_days(self) -> DataFrame:
        """Days on which missions reported, with the last report's time."""
        day = F.col("l_shipdate").cast("date")
        lines = self.table("lineitem").groupBy(F.col("l_orderkey").alias("mission_id"), day.alias("mission_date"))
        return lines.agg(F.max("l_shipdate").alias("last"))

    @cached_property
    def manifests(self) -> DataFrame:
        return self._manifests(self.report_days)

    @cached_property
    def manifests_by_mission(self) -> DataFrame:
        """The manifests dealt out by mission before their long names are made, for joins by mission."""
        return self._manifests(self.report_days.repartition("mission_id"))

    def _manifests(self, days: DataFrame) -> DataFrame:
        report, manifest = [f(F.col("mission_id"), F.col("mission_date")) for f in (report_key, manifest_key)]
        return days.select(
            "mission_id",
            "mission_date",
            manifest.alias("manifest_path"),
            report.alias("mission_file"),
            sha256_hex(report).alias("checksum_mission"),
            sha256_hex(manifest).alias("checksum_manifest"),
            (F.col("last") + F.expr("INTERVAL '18' HOUR")).alias("upload_time"),
            F.lit(C.INGESTED).alias("status"),
        )

    @cached_property
    def early_manifests(self) -> DataFrame:
        return self.manifests.where(F.col("mission_date") < F.lit(T1[:10]).cast("date"))

    @cached_property
    def report_rows(self) -> DataFrame:
        """Report rows as files hold them: text ids and times, with the key of their file."""
        day = F.col("timestamp").cast("date")
        return self.mission_reports.select(
            F.col("mission_id").cast("string").alias("mission_id"),
            "item",
            F.col("value").cast("double").alias("value"),
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            report_key(F.col("mission_id"), day).alias("object_key"),
        )

    @cached_property
    def mission_states(self) -> DataFrame:
        """Last scored state per mission as a manifest object; ships under repair report the nested layout."""
        last = latest_per_key(score_health(self.telemetry), ["mission_id"], "seq")
        nested = F.col("status") == C.REPAIR
        flat = [F.when(~nested, F.col(c)).alias(c) for c in ("coord_x", "coord_y", "coord_z")]
        inside = F.struct(
            F.col("coord_x").alias("x_km"),
            F.col("coord_y").alias("y_km"),
            F.col("coord_z").alias("z_km"),
            F.lit("Ohri").alias("planet"),
        )
        scores = F.struct(*[F.col(f"{s}_health").alias(s) for s in ("motor", "engine", "core", "fuel")])
        state = F.struct(
            "timestamp",
            "ship_id",
            *flat,
            F.when(nested, inside).alias("coordinates"),
            "fuel_prc",
            "motor_temp_c",
            "radiation_uSv",
            "cargo_integrity_prc",
            "status",
            scores.alias("health_scores"),
            "normalized_health_total",
            "ship_condition",
        )
        return last.select(F.col("mission_id").cast("bigint").alias("mission_id"), state.alias("ship_state"))

    @cached_property
    def topic_records(self) -> DataFrame:
        return events_as_records(self.table("events"))


def bind_events(events: DataFrame) -> DataFrame:
    """Telemetry rows from events; a projection, so it also runs on a stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind, value = F.col("event_type"), F.col("value")
    mission = F.col("user_id") * 100 + F.col("event_id") % 20
    failed = (kind == "signup") & (k < 20)
    x, y, z = k * F.lit(1.0e6), value * F.lit(1.0e6), -k * F.lit(0.5e6)
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("timestamp"),
        mission.cast("string").alias("mission_id"),
        _padded("SS_", mission % 23).alias("ship_id"),
        x.alias("coord_x"),
        y.alias("coord_y"),
        z.alias("coord_z"),
        k.cast("double").alias("fuel_prc"),
        (F.lit(25.0) + value / 2).alias("motor_temp_c"),
        (F.lit(90.0) + value * 1.8).alias("engine_pressure_kpa"),
        (F.lit(290.0) + value * 2).alias("power_core_temp_c"),
        (F.lit(-100.0) + k / F.lit(2.0)).alias("navigation_signal_db"),
        distance_from_origin(x, y, z).alias(C.ORIGIN_DISTANCE),
        F.when(kind == "error", C.REPAIR).when(failed, C.FAILURE).otherwise(C.OK).alias("status"),
        F.when(failed, C.FAILURE).when((kind == "purchase") & (k >= 90), C.SUCCESS).alias("mission_status"),
        F.when((kind == "click") & (k >= 80), "motor_temp_c").alias("malfunctioned_component"),
        F.when(kind == "view", value / 50).alias("radiation_uSv"),
        F.when(kind == "click", F.lit(100.0) - k / F.lit(10.0)).alias("cargo_integrity_prc"),
    )


def to_ticks(telemetry: DataFrame) -> DataFrame:
    return telemetry_to_ship_state(score_health(telemetry))


def events_as_records(events: DataFrame) -> DataFrame:
    """Events as topic records of two partitions, a third of them without key; they arrive a millisecond apart, and their
    offset is their number."""
    bound = bind_events(events)
    fields = [f for f in bound.columns if f != "seq"]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return bound.select(
        F.when(F.col("seq") % 3 > 0, F.col("ship_id").cast("binary")).alias("key"),
        text.cast("binary").alias("value"),
        (F.col("seq") % 2).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("seq")).alias("timestamp"),
    )


def terminal_commands(telemetry: DataFrame) -> DataFrame:
    """Completion commands as ships send them, one per terminal event."""
    return telemetry.where(is_terminal()).select(
        F.col("seq").alias("command_id"),
        F.col("mission_id").cast("bigint").alias("mission_id"),
        F.lower("mission_status").alias("status"),
    )


def _padded(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 2, "0"))


