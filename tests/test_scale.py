"""What is dealt out, computed and held at once by jobs that grow with their tables."""

import datetime as dt
import time

from pyspark.sql import functions as F

from conftest import rows
from wakeline.operators import keys as K, quality as DQ
from wakeline.plans import ingest as I, refresh as RF, reports as RP, serving as S
from wakeline.schemas import WAITING
from wakeline.session import stored
from wakeline.sinks.files import export_reports
from wakeline.sinks.landing import write_waiting
from wakeline.sources.files import newest_run, read_report_rows
from wakeline.sources.tables import BucketTable
from wakeline.sources.telemetry import parse_telemetry

REPORTS = "mission_id string, item string, value double, timestamp string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange ")


def test_sums_of_row_hashes_are_longs_and_objects_without_mission_or_day_meet(spark, table):
    sent = table([("1", "a", 1.0, "2001-01-01 00:00:00"), (None, "b", 2.0, "2001-01-01 00:00:00"), ("2", "c", 3.0, None), (None, None, None, None)], REPORTS)
    objects = RP.report_objects(sent)
    assert "decimal(30,0)" not in plan(objects)
    manifests = objects.select(F.col("object_key").alias("mission_file"), F.col("checksum").alias("checksum_mission"), "object")
    assert DQ.checksum_mismatch(manifests, RP.report_objects(sent)).count() == 0
    other = RP.report_objects(sent.withColumn("value", F.when(F.col("item") == "b", 9.0).otherwise(F.col("value"))).where("mission_id is null or mission_id <> '2'"))
    assert rows(DQ.checksum_mismatch(manifests, other).select("key")) == [("2",), ("2001-01-01",)]


def test_objects_meet_without_being_dealt_out_again(spark, table):
    sent = table([("1", "a", 1.0, "2001-01-01 00:00:00")], REPORTS)
    manifests = RP.report_objects(sent).select(F.col("object_key").alias("mission_file"), F.col("checksum").alias("checksum_mission"), "object")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(DQ.checksum_mismatch(manifests, RP.report_objects(sent))) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_newest_run_keeps_the_rows_of_an_objects_last_run(spark, table, tmp_path):
    path, day = str(tmp_path), "2001-01-01 00:00:00"
    export_reports(table([("1", "a", 1.0, day), ("2", "b", 1.0, day), ("2", "b", 1.0, day)], REPORTS), path, 0, "runs")
    export_reports(table([("1", "a", 5.0, day)], REPORTS), path, 1, "runs")
    got = newest_run(read_report_rows(spark, path))
    assert rows(got.select("mission_id", "value", "run_id")) == [("1", 5.0, 1), ("2", 1.0, 0), ("2", 1.0, 0)]
    assert rows(got.select("object_key", F.col("report_date").cast("string"))) == rows(
        got.select(F.concat("mission_id", F.lit("/2001-01-01/mission_"), "mission_id", F.lit("_20010101.parquet")), F.lit("2001-01-01"))
    )


def test_what_writes_shuffled_goes_with_them(spark, table, tmp_path):
    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    spread = spark.range(1000).select(F.lit("1").alias("mission_id"), F.col("id").cast("string").alias("item"), F.lit(1.0).alias("value"),
                                      F.lit("2001-01-01 00:00:00").alias("timestamp")).repartition("item")
    assert stored(spread, "spread").count() == 1000
    export_reports(spread, str(tmp_path), 0, "runs")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert read_report_rows(spark, str(tmp_path)).where("item is not null").count() == 1000
    kept = {n.split("_")[1] for n in shuffled() - before}
    for _ in range(50):  # they go in the background
        kept = {n.split("_")[1] for n in shuffled() - before}
        if len(kept) <= 2:  # the counts' own
            break
        time.sleep(0.1)
    assert len(kept) <= 2


def test_objects_of_the_newest_run_are_dealt_out_once(spark, table, tmp_path):
    path, day = str(tmp_path), "2001-01-01 00:00:00"
    export_reports(table([("1", "a", 1.0, day), ("2", "b", 1.0, day), (None, "c", 1.0, day), ("3", "d", 1.0, None)], REPORTS), path, 0, "runs")
    export_reports(table([("1", "a", 5.0, day), (None, "c", 6.0, day)], REPORTS), path, 1, "runs")
    export_reports(table([("1", "a", 7.0, day)], REPORTS), path, 2, "runs")
    stored_rows = RP.with_object(read_report_rows(spark, path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = newest_run(stored_rows, "object")
        objects = RP.report_objects(newest)
        assert exchanges(objects) == 2  # the rows, and the objects of later runs
        assert rows(newest.select("mission_id", "value", "run_id")) == [(None, 6.0, 1), ("1", 7.0, 2), ("2", 1.0, 0), ("3", 1.0, 0)]
        sent = table([("1", "a", 7.0, day), ("2", "b", 1.0, day), (None, "c", 6.0, day), ("3", "d", 1.0, None)], REPORTS)
        assert rows(objects.select("object_key", "checksum")) == rows(RP.report_objects(sent).select("object_key", "checksum"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicate_keys_are_counted_in_parts(spark, table):
    held = table([(i, "x") for i in range(40)] + [(7, "y"), (None, "z"), (None, "z")], "k long, v string")
    got = K.duplicate_keys(held, ["k"], rows_per_task=10)
    assert rows(got) == [(None, 2), (7, 2)]
    assert got.rdd.getNumPartitions() == 5


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path, table):
    kept = BucketTable(spark, str(tmp_path), ("k",), table([], "k long, v string").schema, buckets=1)
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "64k")
    spark.conf.set(names[1], "false")
    try:
        batch = spark.range(60_000).repartition(8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        kept.put(batch, 0)
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert len(list((tmp_path / "bucket=0" / "version=0").glob("part-*"))) > 1
    assert kept.read().count() == kept.read().select("k").distinct().count() == 60_000


def test_the_destination_summary_reads_stored_summaries(spark, monkeypatch):
    from checks.bindings import Bound

    b = Bound(spark, "/root/testdata/sf0.001")
    inputs = (b.missions, b.ship_state, b.mission_reports, b.manifests, "2002-01-01 00:00:00")
    kept, plain = RF.bl_rebuild(*inputs, keep=True), RF.bl_rebuild(*inputs)
    assert "lineitem" not in plan(kept["planet_summary"]) and "lineitem" in plan(plain["planet_summary"])
    for name in plain:
        assert rows(kept[name]) == rows(plain[name])


def test_texts_stay_where_they_are_when_nothing_waits(spark, table, tmp_path):
    texts = table([("a", "{}"), ("b", "{}"), ("c", "{}")], "manifest_path string, text string")
    write_waiting(texts, texts.where("manifest_path = 'b'"), str(tmp_path), 3)
    write_waiting(texts, texts.limit(0), str(tmp_path), 4)
    assert rows(spark.read.schema(WAITING).parquet(f"{tmp_path}/waiting/run_id=3")) == [("b", "{}")]
    assert spark.read.schema(WAITING).parquet(f"{tmp_path}/waiting/run_id=4").count() == 0


def test_checksums_are_stored_as_bytes_between_the_steps_of_an_ingest(spark, table, monkeypatch):
    text = '{"mission_id": "1", "date": "2001-01-01", "files": {"mission": "f"}, "checksum": {"mission": "%s"}, "upload_time": "2001-01-01T18:00:00"}'
    sums = ["ab" * 32, "Not a checksum"]
    docs = table([(f"m{i}", text.replace('"1"', f'"{i}"').replace('"f"', f'"f{i}"') % c) for i, c in enumerate(sums)], "manifest_path string, text string")
    report_rows = table([(str(i), "x", 1.0, "2001-01-01 00:00:00", f"f{i}") for i in range(2)], REPORTS + ", object_key string")
    kept = []
    keep = I.stored
    monkeypatch.setattr(I, "stored", lambda df, *a: kept.append(df) or keep(df, *a))
    landing = I.ingest_manifests(I.parse_manifests(docs), report_rows, table([], "mission_id long, mission_date date"), "2002-01-01 00:00:00")
    assert kept[0].schema["checksum"].dataType["bytes"].dataType.simpleString() == "binary"
    assert not {"date", "files"} & set(kept[0].columns)
    assert sorted(r.checksum_mission for r in landing.manifests.collect()) == sorted(sums)
    assert sorted(r.file_checksum for r in landing.reports.collect()) == sorted(sums)
    assert {len(r.checksum_manifest) for r in landing.manifests.collect()} == {64}


def test_kept_marts_follow_cells_without_names(spark, table, tmp_path):
    at = lambda d: dt.datetime(2001, 1, d)
    schema = "mission_id long, ship_name string, captain string, target string, status string, finished_at timestamp_ntz, avg_health decimal(10,3), uptime_ratio decimal(10,3), min_fuel_prc decimal(10,3), max_temp_c decimal(10,3), mission_duration_hr decimal(10,3), total_value_poko decimal(20,2)"
    row = lambda m, ship, end: (m, ship, None, "t", "SUCCESS", end, None, None, None, None, None, None)
    kept = S.KeptMarts.build(spark, str(tmp_path), table([row(1, None, at(9)), row(2, None, at(3)), row(3, "s", at(5))], schema), 2)
    kept.update(table([row(1, None, at(1))], schema), 1)
    assert rows(kept.cells.read().select("ship_name", "rows", F.col("last_mission_end").cast("date").cast("string"))) == [(None, 2, "2001-01-03"), ("s", 1, "2001-01-05")]


def test_events_of_a_stream_are_dealt_out_before_they_are_parsed(spark):
    from checks import suite
    from checks.bindings import Bound

    analysed = suite._event_stream(Bound(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [event_id" in analysed


def test_a_telemetry_record_is_parsed_once_however_it_is_filtered(spark, table):
    records = table([(1, '{"mission_id": "1", "ship_id": "s"}'), (2, "{"), (3, None), (4, '{"ship_id": "s"}')], "seq long, value string")
    parsed = parse_telemetry(records, keep=("seq",))
    assert rows(parsed.select("seq", "mission_id", "ship_id")) == [(1, "1", "s"), (2, None, None), (3, None, None), (4, None, "s")]
    named = parsed.where("mission_id is not null and ship_id is not null and fuel_prc is null")
    assert named._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows(named.select("seq")) == [(1,)]
