"""Files to landing tables: documents, reports, logs, hashes, audit."""

import hashlib
import json
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F

from tests.conftest import rows
from wakeline import catalogue as C
from wakeline.operators import quality as DQ
from wakeline.operators.reshape import split_encodable, to_topic_records
from wakeline.plans import ingest as I, reports as R
from wakeline.schemas import MANIFESTS, MISSION_REPORTS, RAW_REPORT, REJECTED, SHIP_STATE, land
from wakeline.sinks.files import export_reports, write_audit_log, write_manifest_documents, write_raw_logs, write_sorted
from wakeline.sinks import landing as LD
from wakeline.sinks.landing import append_landing, ingested_only, read_landing, read_registered, read_waiting
from wakeline.sources.files import (
    file_hashes,
    read_manifest_rows,
    read_manifest_texts,
    read_manifests,
    read_mission_logs,
    read_report_rows,
    read_reports,
)

NOW = datetime(2025, 10, 11, 12, 0, 0)
DAY = "3025-10-11"


def put(root, key, data):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return hashlib.sha256(path.read_bytes()).hexdigest()


def put_report(root, mission, items):
    import pyarrow as pa
    import pyarrow.parquet as pq

    key = f"{mission}/{DAY}/mission_{mission}_30251011.parquet"
    (root / key).parent.mkdir(parents=True, exist_ok=True)
    cols = {"mission_id": [mission] * len(items), "item": [i for i, _ in items], "value": [float(v) for _, v in items],
            "timestamp": [f"{DAY} 09:00:00"] * len(items)}
    pq.write_table(pa.table(cols), root / key)
    return key, hashlib.sha256((root / key).read_bytes()).hexdigest()


def put_manifest(root, mission, report_key, checksum, state=None, name=None, **extra):
    doc = {"mission_id": mission, "date": DAY, "files": {"mission": report_key}, "checksum": {"mission": checksum},
           "upload_time": f"{DAY}T18:00:00Z", **extra}
    if state is not None:
        doc["ship_state"] = state
    put(root, f"{mission}/{DAY}/{name or f'manifest_{mission}_30251011'}.json", json.dumps(doc, indent=2))


@pytest.fixture
def store(tmp_path):
    """Missions 1 to 4: flat state, nested state, empty state, no state."""
    root = tmp_path / "store"
    flat = {"timestamp": "t", "coord_x": 1.5, "coord_y": -2.5, "coord_z": 3.0, "fuel_prc": 55.555, "motor_temp_c": 90.25,
            "health_scores": {"motor": 1.0, "engine": 0.5, "core": 0.25, "fuel": 0.556}, "normalized_health_total": 0.7, "ship_condition": "MID",
            "coordinates": {}}
    nested = {"fuel_prc": 40, "ship_condition": "DAMAGED", "temperature_C": -12.3, "radiation_uSv": 1.25, "cargo_integrity_prc": 90,
              "coordinates": {"x_km": 7.0, "y_km": 8.0, "planet": "Ohri"}}
    for mission, state in (("1", flat), ("2", nested), ("3", {}), ("4", None)):
        key, sha = put_report(root, mission, [("Crystal King", 1200), ("Crystal King", 1200)])
        put_manifest(root, mission, key, sha, state)
    return root


def run(spark, store, target, as_of=NOW, run_id=1):
    docs = I.parse_manifests(read_manifest_texts(spark, str(store)))
    landing = I.ingest_manifests(docs, read_reports(spark, str(store)), read_landing(spark, str(target), "manifests", MANIFESTS), as_of)
    append_landing(landing, str(target), run_id)


def test_ingest_files(spark, store, tmp_path):
    target = tmp_path / "landing"
    run(spark, store, target)
    reports = read_landing(spark, str(target), "mission_reports", MISSION_REPORTS)
    assert reports.count() == 8
    first = reports.where("mission_id = 1").first()
    assert (first["item"], first["value"], first["source_file"]) == ("Crystal King", 1200, f"1/{DAY}/mission_1_30251011.parquet")
    assert first["loaded_at"] == NOW and len(first["file_checksum"]) == 64
    manifests = read_landing(spark, str(target), "manifests", MANIFESTS).orderBy("mission_id").collect()
    assert [m["mission_id"] for m in manifests] == [1, 2, 3, 4]
    assert manifests[0]["manifest_path"] == f"1/{DAY}/manifest_1_30251011.json" and manifests[0]["status"] == "INGESTED"
    assert str(manifests[0]["mission_date"]) == DAY and str(manifests[0]["upload_time"]) == f"{DAY} 18:00:00"
    text = (store / manifests[0]["manifest_path"]).read_bytes()
    assert manifests[0]["checksum_manifest"] == hashlib.sha256(text).hexdigest()


def test_state_layouts_and_defaults(spark, store, tmp_path):
    run(spark, store, tmp_path / "landing")
    states = read_landing(spark, str(tmp_path / "landing"), "ship_state", SHIP_STATE).orderBy("mission_id").collect()
    assert [s["mission_id"] for s in states] == [1, 2]
    flat, nested = states
    assert (flat["coord_x"], flat["coord_y"], flat["planet"]) == (2, -3, "UNKNOWN")
    assert (flat["temperature_C"], flat["radiation_uSv"], flat["cargo_integrity_prc"]) == (Decimal("90.3"), 0, 100)
    assert (flat["fuel_prc"], flat["core_health"], flat["status"]) == (Decimal("55.56"), Decimal("0.250"), None)
    assert NOW <= flat["timestamp"] < NOW + timedelta(seconds=4)
    assert (nested["coord_x"], nested["coord_z"], nested["planet"]) == (7, 0, "Ohri")
    assert (nested["temperature_C"], nested["normalized_health_total"], nested["ship_condition"]) == (Decimal("-12.3"), None, "DAMAGED")


def test_second_run_takes_new_pairs_only_and_reruns_are_idempotent(spark, store, tmp_path):
    target = tmp_path / "landing"
    run(spark, store, target)
    key, sha = put_report(store, "5", [("Dream Architect", 1000)])
    put_manifest(store, "5", key, sha)
    put_manifest(store, "5", key, sha, name="manifest_zz")  # same mission and date: the first path wins
    run(spark, store, target, run_id=2)
    manifests = read_landing(spark, str(target), "manifests", MANIFESTS)
    assert manifests.count() == 5
    assert manifests.where("mission_id = 5").first()["manifest_path"].endswith("manifest_5_30251011.json")
    assert read_landing(spark, str(target), "mission_reports", MISSION_REPORTS).count() == 9
    run(spark, store, target, run_id=3)
    assert manifests.sparkSession.read.parquet(f"{target}/manifests").count() == 5


def test_unregistered_rows_stay_hidden_and_are_replaced(spark, store, tmp_path):
    """A run that dies before its registrations leaves rows no reader counts; the rerun replaces them."""
    target = str(tmp_path / "landing")
    docs = I.parse_manifests(read_manifest_texts(spark, str(store)))
    landing = I.ingest_manifests(docs, read_reports(spark, str(store)), spark.createDataFrame([], MANIFESTS), NOW)
    land(landing.reports, MISSION_REPORTS).write.parquet(f"{target}/mission_reports/run_id=1")
    none = read_landing(spark, target, "manifests", MANIFESTS)
    assert ingested_only(read_landing(spark, target, "mission_reports", MISSION_REPORTS), none).count() == 0
    run(spark, store, target)
    done = read_landing(spark, target, "manifests", MANIFESTS)
    assert ingested_only(read_landing(spark, target, "mission_reports", MISSION_REPORTS), done).count() == 8


def test_object_exported_again_is_replaced(spark, table, tmp_path):
    schema, out = "mission_id string, item string, value double, timestamp string", str(tmp_path / "r")
    export_reports(table([("1", "old", 1.0, f"{DAY} 09:00:00"), ("2", "kept", 1.0, f"{DAY} 09:00:00")], schema), out, 0)
    export_reports(table([("1", "new", 2.0, f"{DAY} 09:00:00")], schema), out, 1)
    doc = table([(m, DAY, f"{m}/{DAY}/mission_{m}_30251011.parquet", f"p{m}") for m in ("1", "2", "3")], "m string, d string, k string, p string")
    texts = doc.select(F.col("p").alias("manifest_path"), F.to_json(F.struct(F.col("m").alias("mission_id"), F.col("d").alias("date"), F.struct(F.col("k").alias("mission")).alias("files"))).alias("text"))
    landing = I.ingest_manifests(I.parse_manifests(texts), read_report_rows(spark, out), spark.createDataFrame([], MANIFESTS), NOW)
    assert rows(landing.reports.select("mission_id", "item")) == [(1, "new"), (2, "kept")]
    assert rows(landing.manifests.select("mission_id")) == [(1,), (2,)]
    assert rows(landing.waiting.select("mission_id", "manifest_path")) == [(3, "p3")]


def test_manifest_without_report_waits_and_stops_nobody(spark, store, tmp_path):
    from wakeline.streaming import jobs as J

    target, late, never = str(tmp_path / "landing"), f"8/{DAY}/mission_8_30251011.parquet", f"9/{DAY}/mission_9_30251011.parquet"
    put_manifest(store, "8", late, "c" * 64)
    put_manifest(store, "9", never, "d" * 64)

    def run_stream():
        query = J.run_ingest(J.new_manifest_files(spark, str(store)), lambda: read_reports(spark, str(store)), target, str(tmp_path / "c"), lambda: NOW)
        query.awaitTermination()
        assert query.exception() is None
        return sorted(m["mission_id"] for m in read_landing(spark, target, "manifests", MANIFESTS).collect())

    assert run_stream() == [1, 2, 3, 4]
    put_report(store, "8", [("Dream Architect", 1000)])
    key, sha = put_report(store, "5", [("Dream Architect", 1000)])
    put_manifest(store, "5", key, sha)
    assert run_stream() == [1, 2, 3, 4, 5, 8]
    key, sha = put_report(store, "6", [("Dream Architect", 1000)])
    put_manifest(store, "6", key, sha)
    assert run_stream() == [1, 2, 3, 4, 5, 6, 8]
    assert [r["manifest_path"] for r in read_waiting(spark, target, 99).collect()] == [f"9/{DAY}/manifest_9_30251011.json"]
    assert read_landing(spark, target, "mission_reports", MISSION_REPORTS).count() == 11


def test_both_manifest_readers_agree(spark, store):
    typed = read_manifests(spark, str(store)).select("manifest_path", "mission_id", "files.mission", "ship_state.coordinates.x_km")
    parsed = I.parse_manifests(read_manifest_texts(spark, str(store))).select("manifest_path", "mission_id", "files.mission", "ship_state.coordinates.x_km")
    assert rows(typed) == rows(parsed) and typed.count() == 4


def test_broken_documents_and_misfits_are_listed(spark, store, tmp_path):
    target = str(tmp_path / "landing")
    put(store, "9/x.json", "{not json")
    put(store, "9/y.json", '{"mission_id": "9", "date": "some day"}')
    key, sha = put_report(store, "5", [("Dream Architect", 1000), ("Crystal King", 1e17)])
    put_manifest(store, "5", key, sha, {"fuel_prc": 12345.0, "temperature_C": 99999.9, "ship_condition": "GOOD"})
    run(spark, store, target)
    assert read_landing(spark, target, "manifests", MANIFESTS).count() == 5
    rejected = rows(read_landing(spark, target, "rejected", REJECTED).select("source", "reason", "detail"))
    assert [(s, r) for s, r, _ in rejected if r == "no readable mission or date"] == [("9/x.json", "no readable mission or date"), ("9/y.json", "no readable mission or date")]
    assert [(s, d) for s, r, d in rejected if r == "report row does not fit"] == [(key, "value=1.0E17")]
    assert [(s, d) for s, r, d in rejected if r == "reading does not fit"] == [(key, "fuel_prc=12345.0, temperature_C=99999.9")]
    landed = read_landing(spark, target, "mission_reports", MISSION_REPORTS).where("mission_id = 5")
    assert rows(landed.select("item")) == [("Dream Architect",)]
    assert rows(read_landing(spark, target, "ship_state", SHIP_STATE).where("mission_id = 5").select("fuel_prc", "ship_condition")) == [(None, "GOOD")]


def test_checksums(spark, store, tmp_path):
    run(spark, store, tmp_path / "landing")
    manifests = read_landing(spark, str(tmp_path / "landing"), "manifests", MANIFESTS)
    assert DQ.checksum_mismatch(manifests, file_hashes(spark, str(store), "*.parquet")).count() == 0
    with open(store / f"2/{DAY}/mission_2_30251011.parquet", "ab") as f:
        f.write(b"x")
    bad = DQ.checksum_mismatch(manifests, file_hashes(spark, str(store), "*.parquet"))
    assert rows(bad) == [("manifests", "checksum", f"2/{DAY}/mission_2_30251011.parquet", 1)]


def test_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    import hashlib

    (tmp_path / "a b").mkdir()
    contents = {"a b/x.bin": b"1", "y%20z.bin": b"q" * 3_000_000, "é.bin": bytes(range(256)) * 5000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    got = {r.object_key: (r.length, r.sha256) for r in file_hashes(spark, str(tmp_path)).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_object_checksums_see_every_change(table):
    rows_ = [("1", f"item{i % 7}", float(i), f"{DAY} 09:00:{i % 60:02d}") for i in range(200)] + [("2", None, None, f"{DAY} 09:00:00")]
    schema = "mission_id string, item string, value double, timestamp string"
    first = {r.mission_id: r.checksum for r in R.report_objects(table(rows_, schema)).collect()}
    again = {r.mission_id: r.checksum for r in R.report_objects(table(rows_[::-1], schema).repartition(7)).collect()}
    assert first == again and all(len(c) == 64 for c in first.values())
    for change in (rows_[1:], [*rows_, rows_[3]], [("1", "item0", 0.5, rows_[0][3]), *rows_[1:]]):
        other = {r.mission_id: r.checksum for r in R.report_objects(table(change, schema)).collect()}
        assert other["1"] != first["1"] and other["2"] == first["2"]


def test_missions_without_a_period(spark, table):
    """A period of 0 or none, or no start, gives no periodic reports and does not disturb the others; a year of minutes is fine."""
    start = datetime(2025, 1, 1)
    missions = table([(1, start, 0), (2, start, None), (3, None, 5), (4, start, -1), (5, start, 1)], "mission_id bigint, started_at timestamp_ntz, report_freq_min int")
    tick = {n: 1.0 for n in C.TELEMETRY_NUMBERS}
    schema = "seq bigint, timestamp string, mission_id string, ship_id string, " + ", ".join(f"{n} double" for n in C.TELEMETRY_NUMBERS) + ", status string, mission_status string"
    stream = [{"seq": i, "timestamp": "2025-01-01T00:00:05Z", "mission_id": str(i % 6), "ship_id": "S", **tick, "status": "OK", "mission_status": "FAILURE" if i == 8 else None} for i in range(1, 12)]
    got = R.report_snapshots(missions, spark.createDataFrame(stream, schema), "2026-01-01 00:00:00").groupBy("mission_id", "kind").count()
    assert rows(got) == sorted([(1, "start", 1), (2, "start", 1), (2, "final", 1), (3, "start", 1), (4, "start", 1), (5, "start", 1), (5, "periodic", 365 * 1440)], key=str)


def test_raw_logs_to_clean_reports_to_export(spark, table, tmp_path):
    logs = [("12", "Crystal King", "1200", f"{DAY} 09:00:00"), ("12", "Crystal King", "1200", f"{DAY} 09:00:00"), ("007", "Stone of Glory", "300", f"{DAY} 10:30:00")]
    write_raw_logs(table(logs, "mission_id string, item string, value string, timestamp string").coalesce(1), str(tmp_path / "raw"))
    clean = I.clean_reports(read_mission_logs(spark, str(tmp_path / "raw")))
    assert rows(clean) == [("007", "Stone of Glory", 300.0, f"{DAY} 10:30:00"), ("12", "Crystal King", 1200.0, f"{DAY} 09:00:00")]
    for layout, folder in (("rows", f"report_date={DAY}"), ("files", f"report_mission=007/report_date={DAY}")):
        out = tmp_path / layout
        for _ in range(2):  # a rerun replaces its own files
            counter = Observation()
            export_reports(clean, str(out), 0, layout, counter)
            assert counter.get["rows"] == 2
        assert (out / folder).is_dir()
        assert rows(spark.read.schema(RAW_REPORT).parquet(str(out)).select(*clean.columns)) == rows(clean)


def test_reports_stored_as_rows_are_ingested_and_pruned_by_day(spark, table, tmp_path):
    """Export, manifest and ingest without one-file-per-key storage."""
    out, docs = str(tmp_path / "reports"), str(tmp_path / "docs")
    logs = [("12", "Crystal King", 1200.0, f"{DAY} 09:00:00"), ("12", "Stone of Glory", 300.0, "3025-10-12 09:00:00"), ("7", "Stone of Glory", 300.0, f"{DAY} 10:30:00")]
    clean = table(logs, "mission_id string, item string, value double, timestamp string")
    export_reports(clean.where("item <> 'Crystal King'"), out, 0)
    export_reports(clean.where("timestamp < '3025-10-11 10'"), out, 1)  # another run adds an object to a stored day
    objects = R.report_objects(clean)
    assert rows(objects.select("checksum")) == rows(R.report_objects(clean.orderBy(F.desc("item"))).select("checksum"))
    state = table([("12",)], "mission_id string").select("mission_id", F.struct(F.lit("GOOD").alias("ship_condition")).alias("ship_state"))
    write_manifest_documents(R.build_manifests(objects, state, NOW), docs, 0)
    write_manifest_documents(R.build_manifests(objects, state, NOW), docs, 1)
    documents = I.parse_manifests(read_manifest_rows(spark, docs))
    assert documents.count() == 3
    stored = read_report_rows(spark, out)
    landing = I.ingest_manifests(documents.where(f"date = '{DAY}'"), stored, spark.createDataFrame([], MANIFESTS), NOW)
    assert rows(landing.reports.select("mission_id", "item")) == [(12, "Crystal King"), (7, "Stone of Glory")]
    assert "dynamicpruning" in landing.reports._jdf.queryExecution().optimizedPlan().toString()
    everything = I.ingest_manifests(documents, stored, spark.createDataFrame([], MANIFESTS), NOW)
    assert everything.reports.count() == 3 and everything.waiting.count() == 0
    assert DQ.checksum_mismatch(everything.manifests, R.report_objects(stored)).count() == 0
    assert DQ.primary_key(everything.ship_state, "ship_state", ["mission_id", "timestamp"]).count() == 0
    assert everything.ship_state.where("mission_id = 12").count() == 2


def test_manifest_stream_ingests_what_is_new(spark, store, tmp_path):
    from wakeline.streaming import jobs as J

    target = str(tmp_path / "landing")

    def run():
        J.run_ingest(J.new_manifest_files(spark, str(store)), lambda: read_reports(spark, str(store)), target, str(tmp_path / "c"), lambda: NOW).awaitTermination()
        return read_landing(spark, target, "manifests", MANIFESTS).count()

    assert run() == 4
    key, sha = put_report(store, "5", [("Dream Architect", 1000)])
    put_manifest(store, "5", key, sha)
    assert run() == 5 and run() == 5
    assert read_landing(spark, target, "mission_reports", MISSION_REPORTS).count() == 9


def test_manifests_of_a_batch_are_stored_while_it_lasts_and_not_cached(spark, store, tmp_path):
    from wakeline.session import shared_dir
    from wakeline.streaming import jobs as J

    seen, folder = [], Path(shared_dir(spark).removeprefix("file:")) / "wakeline"

    def reports():
        held = [len(list(p.glob("*.parquet"))) for p in folder.glob("manifests-*")]
        seen.append((spark.sparkContext._jsc.getPersistentRDDs().size(), len(held), min(held, default=0) > 0))
        return read_reports(spark, str(store))

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    target = str(tmp_path / "landing")
    J.run_ingest(J.new_manifest_files(spark, str(store)), reports, target, str(tmp_path / "c"), lambda: NOW).awaitTermination()
    assert seen == [(before, 1, True)] and not list(folder.glob("manifests-*"))
    assert read_landing(spark, target, "manifests", MANIFESTS).count() == 4


def test_kept_lineage_lands_the_same_rows(spark, store):
    documents = I.parse_manifests(read_manifest_texts(spark, str(store)))
    reports, none = read_reports(spark, str(store)), spark.createDataFrame([], MANIFESTS)
    whole = I.ingest_manifests(documents, reports, none, NOW)
    part = I.ingest_manifests(documents, reports, none, NOW, keep=False, keep_lineage=True)
    assert whole.reports.count() > 0 and rows(part.reports) == rows(whole.reports)
    assert rows(part.rejected) == rows(whole.rejected) and rows(part.manifests) == rows(whole.manifests)
    texts = part.reports._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in texts and "Window" not in texts  # the manifests are found already


def test_missing_columns_are_named(table):
    with pytest.raises(ValueError, match=r"\['item', 'timestamp'\]"):
        I.clean_reports(table([("1", 2.0)], "mission_id string, value double"))


def test_landing_matches_columns_by_name(table):
    df = table([("9", "x", 5.0, 1)], "source_file string, item string, value double, mission_id int")
    got = land(df, MISSION_REPORTS)
    assert got.columns == MISSION_REPORTS.names and got.first()["mission_id"] == 1 and got.first()["source_file"] == "9"


def registered_run(table, root, run_id, days):
    """An ingest run that registers missions 1, 2, ... of the given days."""
    found = table([(i, date.fromisoformat(d), f"{i}/{d}") for i, d in enumerate(days, 1)], "mission_id bigint, mission_date date, manifest_path string")
    none = table([], "mission_id bigint")
    append_landing(I.Landing(none, none, found, none, none), root, run_id)


@pytest.mark.parametrize("most", [4096, 1])
def test_registrations_of_other_months_are_not_read(spark, table, tmp_path, monkeypatch, most):
    monkeypatch.setattr(LD, "MOST_DAYS", most)
    root = str(tmp_path / "landing")
    for run_id, days in enumerate((["2024-01-05", "2024-01-06"], ["2024-02-01"], ["2024-03-01", "2024-01-05"], ["2024-01-06"])):
        registered_run(table, root, run_id, days)
    for path in (tmp_path / "landing" / "manifests").glob("run_id=*/mission_month=20240[23]/*.parquet"):
        path.write_bytes(b"not to be read")
    documents = table([("2024-01-05",), ("2024-01-06",), ("none",), (None,)], "date string")
    got = read_registered(spark, root, documents, below_run=3)
    assert got.columns == MANIFESTS.names
    assert sorted(r.manifest_path for r in got.collect()) == ["1/2024-01-05", "2/2024-01-05", "2/2024-01-06"]
    one = read_registered(spark, root, documents.where("date = '2024-01-06'"), below_run=9)
    assert sorted(r.manifest_path for r in one.collect()) == ["1/2024-01-06", "2/2024-01-06"]
    assert read_registered(spark, root, documents.where("date = 'none'"), below_run=9).count() == 0
    assert read_registered(spark, str(tmp_path / "empty"), documents, below_run=9).count() == 0


def test_registrations_of_a_rerun_replace_its_own(spark, table, tmp_path):
    root = str(tmp_path / "landing")
    registered_run(table, root, 1, ["2024-01-05", "2024-02-05"])
    registered_run(table, root, 1, ["2024-01-05"])
    assert [r.manifest_path for r in read_landing(spark, root, "manifests", MANIFESTS).collect()] == ["1/2024-01-05"]


def test_manifest_documents_written_and_read_back(spark, table, tmp_path):
    state = F.struct(F.lit(1.0).alias("coord_x"), F.lit("GOOD").alias("ship_condition")).alias("ship_state")
    files = table([(12, DAY, f"12/{DAY}/mission_12_30251011.parquet", "c" * 64)], "mission_id bigint, mission_date string, object_key string, checksum string")
    docs = R.build_manifests(files.withColumn("mission_date", F.col("mission_date").cast("date")), table([(12,)], "mission_id bigint").select("mission_id", state), NOW)
    body = json.loads(docs.first()["text"])
    assert body["mission_id"] == "12" and body["date"] == DAY and body["upload_time"] == f"{DAY}T18:00:00Z"
    assert body["ship_state"] == {"coord_x": 1.0, "ship_condition": "GOOD"}
    write_manifest_documents(docs, str(tmp_path / "m"), layout="files")
    write_manifest_documents(docs, str(tmp_path / "m"), layout="files")
    got = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "m"))
    assert [json.loads(r["value"]) for r in got.collect()] == [body]


FILE_NAMES = [("mission_12_30251011.parquet", "12", "mission"), ("manifest_30251011.json", "unknown", "manifest"), ("foo", "unknown", "file"),
              ("log_a_7_8.txt", "7", "log"), (".hidden_5", "5", ".hidden")]


@pytest.mark.parametrize("name,mission,kind", FILE_NAMES)
def test_audit_event(table, name, mission, kind):
    row = R.upload_audit_log(table([(name, "missions", "n/a", False)], "file_name string, source_bucket string, checksum string, success boolean"), NOW).first()
    assert (row["mission_id"], row["status"], row["timestamp"]) == (mission, "FAIL", f"{DAY}T12:00:00Z")
    assert row["object_key"] == f"{DAY}/mission_{mission}/log_{kind}_{mission}_{DAY}T12-00-00Z.json"


def test_audit_log_is_stored_by_day_and_mission(spark, table, tmp_path):
    files = table([("mission_1_30251011.parquet", "b", "c", True, "77")], "file_name string, source_bucket string, checksum string, success boolean, mission_id string")
    write_audit_log(R.upload_audit_log(files, NOW), str(tmp_path / "by_day"))
    assert spark.read.json(str(tmp_path / "by_day")).first()["object_key"].startswith(f"{DAY}/mission_77/")
    write_audit_log(R.upload_audit_log(files, NOW), str(tmp_path / "log"), by_mission=True)
    assert (tmp_path / "log" / f"log_date={DAY}" / "log_mission=77").is_dir()
    assert spark.read.json(str(tmp_path / "log")).first()["status"] == "SUCCESS"


def test_topic_records(table):
    df = table([("SS_ÉTOILE", 42.0, None)], "ship_id string, coord_x double, status string")
    good, dead = split_encodable(to_topic_records(df))
    assert dead.count() == 0
    assert (good.first()["key"], json.loads(good.first()["value"])) == ("SS_ÉTOILE", {"ship_id": "SS_ÉTOILE", "coord_x": 42.0, "status": None})
    _, dead = split_encodable(table([("k", None)], "key string, value string"))
    assert "serialization_error" in dead.first()["value"]
    odd = table([("a", 1.0, 2.0), ("b", float("nan"), 2.0), ("c", 1.0, float("-inf")), ("d", None, None)], "ship_id string, x double, y double")
    good, dead = split_encodable(to_topic_records(odd))
    assert (rows(good.select("key")), rows(dead.select("key"))) == ([("a",), ("d",)], [("b",), ("c",)])


def test_snapshots(spark, table):
    missions = table([(1, datetime(2025, 1, 1), 2)], "mission_id bigint, started_at timestamp_ntz, report_freq_min int")
    tick = {n: 1.0 for n in C.TELEMETRY_NUMBERS}

    def event(seq, second, status, end=None):
        return {"seq": seq, "timestamp": f"2025-01-01T00:{second // 60:02d}:{second % 60:02d}+00:00", "mission_id": "1", "ship_id": "S", **tick, "status": status, "mission_status": end}

    schema = "seq bigint, timestamp string, mission_id string, ship_id string, " + ", ".join(f"{n} double" for n in C.TELEMETRY_NUMBERS) + ", status string, mission_status string"
    stream = [event(1, 5, "OK"), event(2, 100, "REPAIR"), event(3, 130, "OK"), event(4, 250, "OK"), event(5, 260, "FAILURE", "FAILURE"), event(6, 300, "OK")]
    snaps = R.report_snapshots(missions, spark.createDataFrame(stream, schema), "2025-01-01 01:00:00")
    got = rows(snaps.select("report_no", "kind", "timestamp", "status"), "report_no", "kind")
    assert [(n, k, s) for n, k, _, s in got] == [(0, "start", "OK"), (1, "periodic", "REPAIR"), (2, "periodic", "OK"), (3, "final", "FAILURE")]
    state = R.latest_states(snaps).first()["ship_state"]
    assert state["status"] == "FAILURE" and state["ship_condition"] == "UNOPERATIONAL"


def test_snapshots_follow_the_clock(spark, table):
    """Period one minute, ticks at 0, 30 and 190 s: every closed period has a report, the running one has none yet."""
    missions = table([(1, datetime(2025, 1, 1), 1)], "mission_id bigint, started_at timestamp_ntz, report_freq_min int")
    tick = {n: 1.0 for n in C.TELEMETRY_NUMBERS}
    schema = "seq bigint, timestamp string, mission_id string, ship_id string, " + ", ".join(f"{n} double" for n in C.TELEMETRY_NUMBERS) + ", status string, mission_status string"

    def snaps(as_of, *events):
        stream = [{"seq": i, "timestamp": f"2025-01-01T00:{s // 60:02d}:{s % 60:02d}+00:00", "mission_id": "1", "ship_id": "S", **tick, "fuel_prc": float(s), "status": "OK", "mission_status": end}
                  for i, (s, end) in enumerate(events)]
        got = R.report_snapshots(missions, spark.createDataFrame(stream, schema), f"2025-01-01 00:{as_of // 60:02d}:{as_of % 60:02d}")
        return rows(got.select("report_no", "kind", "fuel_prc"), "report_no", "kind")

    open_ = [(0, None), (30, None), (190, None)]
    at = {t: snaps(t, *open_) for t in (59, 60, 200, 240, 300)}
    assert at[59] == [(0, "start", 0.0)]
    assert at[60] == [(0, "start", 0.0), (1, "periodic", 30.0)]
    assert at[200] == [(0, "start", 0.0), (1, "periodic", 30.0), (2, "periodic", 30.0), (3, "periodic", 30.0)]
    assert at[240] == [*at[200], (4, "periodic", 190.0)] and at[300] == [*at[240], (5, "periodic", 190.0)]
    ended = [*open_, (250, "SUCCESS"), (290, None)]
    assert snaps(245, *ended) == at[240]
    assert snaps(900, *ended) == [*at[240], (5, "final", 250.0)]


def test_sorted_mart(spark, table, tmp_path):
    write_sorted(table([(i,) for i in range(50)], "v int").repartition(3), str(tmp_path / "s"), F.desc("v"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 50


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_parsed_once(spark, table):
    """Filters on a document's fields do not parse its text again each."""
    texts = table([("p", '{"mission_id": "1", "date": "2025-01-01"}'), ("q", "{not json"), ("r", None)], "manifest_path string, text string")
    new = I.new_manifests(I.parse_manifests(texts), spark.createDataFrame([], MANIFESTS))
    assert _plan(new).count("from_json") == 1
    assert rows(new.select("mission_id", "manifest_path")) == [(1, "p")]
    assert rows(I.parse_manifests(texts).select("manifest_path", "mission_id")) == [("p", "1"), ("q", None), ("r", None)]


def test_manifests_are_dealt_out_before_their_names_are_made(spark, tmp_path):
    from checks.bindings import TABLES, Bound
    from checks.suite import _documents

    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    above = _plan(_documents(Bound(spark, str(tmp_path)))).split("sha2(", 1)[0]
    assert "Exchange" not in above


def test_checksums_keep_their_text(table):
    """Sums travel as bytes; what is no lower-case hex, or missing, comes through as it is."""
    sums = ["00ff" * 16, "ABCD", "abc", "", None, "x"]
    docs = table([(f"p{i}", f"c{i}", str(i), "2025-01-01", ("f",), (s,)) for i, s in enumerate(sums)],
                 "manifest_path string, checksum_manifest string, mission_id string, date string, files struct<mission:string>, checksum struct<mission:string>")
    new = I.new_manifests(docs, table([], "mission_id bigint, mission_date date"))
    assert [r[0] for r in new.orderBy("mission_id").select("checksum.mission").collect()] == sums
    assert [r[0] for r in new.orderBy("mission_id").select("checksum_manifest").collect()] == [f"c{i}" for i in range(6)]


def test_ingest_without_keeping_gives_the_same(spark, table):
    docs = I.parse_manifests(table(
        [(f"{m}", json.dumps({"mission_id": m, "date": "2025-01-01", "files": {"mission": f"f{m}"}, "checksum": {"mission": "ab" * 32}})) for m in "123"],
        "manifest_path string, text string"))
    for runs in ((0, 0), (0, 1)):
        report_rows = table([("1", "a", 1.0, "2025-01-01 00:00:00", "f1", runs[0]), ("1", "b", 2.0, "2025-01-01 00:00:00", "f1", runs[1]),
                             ("2", "c", 1e30, "2025-01-01 00:00:00", "f2", 0)],
                            "mission_id string, item string, value double, timestamp string, object_key string, run_id bigint")
        for got in (report_rows, report_rows.drop("run_id")):
            kept, lazy = [I.ingest_manifests(docs, got, spark.createDataFrame([], MANIFESTS), NOW, keep) for keep in (True, False)]
            for name, a, b in zip(I.Landing._fields, kept, lazy):
                assert rows(a) == rows(b), name
