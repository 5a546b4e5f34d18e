"""Plans: what reaches the scan, what is shuffled, and what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from checks.bindings import AS_OF, Bound
from checks.suite import QUERIES, _documents
from wakeline.functions.times import instant
from wakeline.operators.keys import cascade
from wakeline.operators.reshape import latest_gauges
from wakeline.plans import business as B, ingest as I
from wakeline.schemas import SHIP_STATE

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


BATCH = [n for n in QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian_no_collected_groups(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert banned not in plan, banned


def test_summary_reads_only_its_columns(spark, tmp_path):
    b = Bound(spark, SF)
    b.ship_state.write.parquet(str(tmp_path / "s"))
    states = spark.read.schema(SHIP_STATE).parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = physical(B.mission_summary(b.missions, states, AS_OF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = next(line for line in re.findall(r"ReadSchema: struct<(.*?)>", plan) if "ship_condition" in line)
    for unread in ("motor_health", "coord_x", "planet", "source_file"):
        assert unread not in schema


def test_ticks_are_merged_before_their_only_shuffle(spark):
    b = Bound(spark, SF)
    plan = physical(B.mission_summary(b.missions, b.ship_state, AS_OF))
    assert "partial_sum(UnscaledValue(normalized_health_total" in plan  # sums of small decimals run on longs
    assert "SortAggregate" not in plan


def test_incremental_filter_reaches_the_missions_scan(spark, tmp_path):
    b = Bound(spark, SF)
    b.missions.write.parquet(str(tmp_path / "m"))
    missions = spark.read.parquet(str(tmp_path / "m"))
    target = B.mission_summary(missions, b.ship_state, "1998-07-01 00:00:00")
    plan = optimized(B.mission_summary(B.changed_missions(missions, target), b.ship_state, AS_OF))
    join, scan = plan.index("Join"), plan.index("Filter ((updated_at")
    assert join < scan and "scalar-subquery" in plan[scan:scan + 200]


def test_event_time_cut_is_pushed_to_the_scan(spark):
    plan = physical(Bound(spark, SF).table("events").where(F.col("ts") < instant("2024-01-16 00:00:00")).select("event_id"))
    assert "LessThan(ts,2024-01-16T00:00)" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_latest_gauges_stay_in_hash_aggregates(spark):
    plan = physical(latest_gauges(Bound(spark, SF).telemetry, "seq"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_upsert_shuffles_each_side_once(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id").alias("mission_id"), F.lit("x").alias("v"))
        from wakeline.operators.upsert import upsert

        assert physical(upsert(df, df.limit(5), ["mission_id"])).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(df, path):
    """How often a plan reads the table at ``path``, exchanges that are used twice counted twice."""
    return sum(str(path) in line for line in physical(df).splitlines() if "FileScan" in line)


def test_ingest_reads_report_rows_once_a_frame(spark, tmp_path):
    b, path = Bound(spark, SF), tmp_path / "rows"
    b.report_rows.write.parquet(str(path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        landing = I.ingest_manifests(I.parse_manifests(_documents(b)), spark.read.parquet(str(path)), b.early_manifests, AS_OF)
        read = {name: scans(df, path) for name, df in landing._asdict().items()}
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert read == {"reports": 1, "ship_state": 0, "manifests": 0, "waiting": 0, "rejected": 1}


def test_cascade_reads_the_children_once_more(spark, tmp_path):
    b, path = Bound(spark, SF), tmp_path / "rows"
    b.mission_reports.write.parquet(str(path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert scans(cascade(spark.read.parquet(str(path)), b.live_missions, "mission_id"), path) == 1
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
