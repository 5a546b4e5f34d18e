"""Streams against their batch twins, restarts, layouts and bad records."""

import json
import random
import subprocess
import sys
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import rows
from wakeline import catalogue as C
from wakeline.operators.reshape import gauge_samples, latest_gauges
from wakeline.plans.radar import radar_latest, radar_transitions
from wakeline.plans.reports import report_snapshots
from wakeline.schemas import TEXT, struct
from wakeline.sources.tables import BucketTable, TableStore
from wakeline.sources.telemetry import malformed, parse_telemetry, read_lake, read_mission, telemetry_source
from wakeline.sinks.lake import write_lake
from wakeline.streaming import jobs as J, states


def event(rng, mission):
    numbers = {n: round(rng.uniform(0, 100), 2) for n in C.TELEMETRY_NUMBERS}
    end = rng.choice([None] * 12 + ["SUCCESS", "FAILURE"])
    return {"timestamp": "2025-10-11T10:45:22.345Z", "mission_id": mission, "ship_id": rng.choice(["A", "B", "C"]), **numbers,
            "status": rng.choice(["OK", "REPAIR"]), "mission_status": end, "health_scores": {"motor": 1.0}}


class Topic:
    """A directory of topic record files."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0

    def send(self, values):
        recs = [(b"k", v if isinstance(v, bytes) else json.dumps(v).encode(), "telemetry.raw", 0, self.offset + i, None) for i, v in enumerate(values)]
        self.offset += len(values)
        self.spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp").coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return telemetry_source(self.spark, "files", path=self.path)

    def batch(self):
        return J.arriving(self.spark.read.parquet(self.path))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stream_over_three_runs_equals_batch(spark, topic, tmp_path):
    rng = random.Random(2)
    store, lake = TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "lake")
    metrics = J.metrics_table(spark, str(tmp_path / "gauges"), buckets=4)
    for _ in range(3):
        topic.send([event(rng, rng.choice(["007", "7", "42"])) for _ in range(60)])
        drain(J.run_telemetry(topic.stream(), str(tmp_path / "c1"), lake, J.DRAIN))
        drain(J.run_radar(topic.stream(), store, str(tmp_path / "c2"), J.DRAIN))
        drain(J.run_transitions(topic.stream(), str(tmp_path / "log"), str(tmp_path / "c3"), J.DRAIN))
        drain(J.run_metrics(topic.stream(), metrics, str(tmp_path / "c4"), J.DRAIN))
    batch = topic.batch()
    columns = batch.columns
    assert rows(read_lake(spark, lake).select(*columns)) == rows(batch)
    assert rows(read_lake(spark, lake).groupBy("batch_id").count()) == [(0, 60), (1, 60), (2, 60)]
    assert rows(metrics.read()) == rows(latest_gauges(batch, "seq"))
    assert rows(store.read("radar_latest").select("ship_id", "seq", "status", "colour")) == rows(radar_latest(batch).select("ship_id", "seq", "status", "colour"))
    assert rows(spark.read.parquet(str(tmp_path / "log")).drop("batch_id"), "seq") == rows(radar_transitions(batch), "seq")


def test_records_of_several_partitions_go_by_their_time(spark, topic, tmp_path):
    """Key-less records of one ship lie in two partitions, whose offsets say nothing about each other."""
    rng = random.Random(6)
    events = [event(rng, "1") | {"ship_id": rng.choice(["A", None])} for _ in range(80)]
    at = datetime(2025, 1, 1, tzinfo=timezone.utc)
    recs, ends = [], [900, 5]
    for i, e in enumerate(events):
        part = rng.randrange(2)
        ends[part] += 1
        recs.append((None, json.dumps(e).encode(), "telemetry.raw", part, ends[part], at + timedelta(milliseconds=i)))
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    for part in (recs[:50], recs[50:]):
        rng.shuffle(part)
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(topic.path)
        drain(J.run_transitions(topic.stream(), str(tmp_path / "log"), str(tmp_path / "c3"), J.DRAIN))
        drain(J.run_radar(topic.stream(), store := TableStore(spark, str(tmp_path / "t")), str(tmp_path / "c2"), J.DRAIN))
        drain(J.run_metrics(topic.stream(), metrics := J.metrics_table(spark, str(tmp_path / "g")), str(tmp_path / "c4"), J.DRAIN))
    ordered = spark.createDataFrame([(r[1], i) for i, r in enumerate(sorted(recs, key=lambda r: r[5]))], "value binary, seq bigint")
    batch = parse_telemetry(ordered, keep=("seq",))
    want = rows(radar_transitions(batch).select("ship_id", "previous", "current"))
    assert rows(spark.read.parquet(str(tmp_path / "log")).select("ship_id", "previous", "current")) == want
    assert rows(store.read("radar_latest").select("ship_id", "status", "fuel_prc")) == rows(radar_latest(batch).select("ship_id", "status", "fuel_prc"))
    assert rows(metrics.read()) == rows(latest_gauges(batch, "seq"))


def test_state_does_not_grow_with_batches(spark, topic, tmp_path):
    """A value a ship, none for a ship whose mission ended, however many batches went by."""
    rng, sizes = random.Random(3), []
    for i in range(6):
        ends = {"C": "SUCCESS"} if i % 2 else {}
        topic.send([event(rng, "1") | {"ship_id": s, "mission_status": ends.get(s)} for s in "ABC" for _ in range(5)])
        query = J.run_transitions(topic.stream(), str(tmp_path / "log"), str(tmp_path / "c"), J.DRAIN)
        drain(query)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sizes == [3, 2, 3, 2, 3, 2]


MISSIONS = "mission_id bigint, report_freq_min int, started_at timestamp_ntz"


def ticks(*events):
    """Events of (mission, minute, more) as records' values."""
    numbers = {n: 1.0 for n in C.TELEMETRY_NUMBERS}
    for mission, minute, more in events:
        at = datetime(2025, 1, 1) + timedelta(minutes=minute)
        yield {"timestamp": at.isoformat() + "Z", "mission_id": str(mission), "ship_id": f"S{mission}", **numbers, "status": "OK", "mission_status": None, **more}


def test_reports_fall_due_in_the_stream(spark, topic, table, tmp_path):
    """Silent missions report by the clock of the others; after every run the reports are those of the batch plan."""
    start = datetime(2025, 1, 1)
    missions = table([(1, 10, start), (2, 7, start + timedelta(minutes=3)), (3, 10, start), (4, 0, start), (5, None, start), (6, 10, None)], MISSIONS)
    runs = [
        [(1, 1, {}), (2, 4, {}), (4, 4, {}), (1, 9, {"status": "REPAIR"}), (5, 12, {}), (3, 14.5, {})],
        [(1, 30, {}), (6, 31, {}), (1, 44.5, {"status": "REPAIR"}), (4, 46, {"mission_status": "FAILURE"})],
        [(1, 61, {}), (1, 62, {"mission_status": "SUCCESS"}), (1, 63, {}), (3, 120, {})],
        [(2, 200, {"fuel_prc": 7.0}), (2, 205, {"mission_status": "FAILURE"}), (6, 206, {"mission_status": "SUCCESS"}), (3, 230.5, {})],
    ]
    out, sent = str(tmp_path / "due"), 0
    for run in runs:
        topic.send(list(ticks(*run)))
        drain(J.run_reports(topic.stream(), missions, out, str(tmp_path / "c"), J.DRAIN))
        as_of = start + timedelta(minutes=max(m for _, m, _ in run))
        got = spark.read.parquet(out).drop("batch_id")
        assert rows(got) == rows(report_snapshots(missions, topic.batch(), as_of).select(*got.columns)), as_of
        assert got.count() > sent
        sent = got.count()


def test_missions_share_state_by_bucket(spark, topic, table, tmp_path):
    """Many missions in three buckets: one value and one timer a bucket, reports as from the batch plan after every run."""
    rng, start = random.Random(9), datetime(2025, 1, 1)
    missions = table([(m, rng.choice([7, 10, 25, 0, None]), start + timedelta(minutes=rng.randrange(40))) for m in range(60)], MISSIONS)
    out, minute, ended = str(tmp_path / "due"), 0.0, set()
    for run in range(3):
        sent = []
        for _ in range(120):
            minute += rng.random()
            m = rng.randrange(20 * (run + 1))
            end = "SUCCESS" if rng.random() < 0.08 and m not in ended else None
            ended |= {m} if end else set()
            sent.append((m, minute, {"mission_status": end, "status": rng.choice(["OK", "REPAIR"])}))
        topic.send(list(ticks(*sent)))
        due = states.due_reports(J.placed(topic.stream()), missions, buckets=3)
        write = due.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}"))
        query = states.start_stateful(write.option("checkpointLocation", str(tmp_path / "c")).trigger(**J.DRAIN), spark)
        drain(query)
        as_of = start + timedelta(minutes=minute)
        got = spark.read.parquet(out).drop("batch_id")
        assert rows(got) == rows(report_snapshots(missions, topic.batch(), as_of).select(*got.columns))
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 3  # a value, a timer and its place in time


def test_mission_ids_stay_text_and_one_mission_can_be_read(spark, topic, tmp_path):
    rng = random.Random(4)
    topic.send([event(rng, m) for m in ["007"] * 5 + ["7"] * 3])
    for layout in ("bucket", "mission"):
        path = str(tmp_path / layout)
        write_lake(topic.batch(), 0, path, layout=layout)
        assert rows(read_lake(spark, path).groupBy("mission_id").count()) == [("007", 5), ("7", 3)]
    assert (tmp_path / "mission" / "mission_id=007").is_dir()
    assert read_mission(spark, str(tmp_path / "bucket"), "007").count() == 5
    plan = read_mission(spark, str(tmp_path / "bucket"), "007")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mission_bucket" in plan


def test_retried_batch_replaces_itself(spark, topic, tmp_path):
    topic.send([event(random.Random(1), "1") for _ in range(20)])
    for _ in range(2):
        write_lake(topic.batch(), 0, str(tmp_path / "lake"), rows_per_file=4)
    write_lake(topic.batch(), 1, str(tmp_path / "lake"))
    assert read_lake(spark, str(tmp_path / "lake")).count() == 40


def test_hot_mission_is_written_by_several_tasks(spark, topic, tmp_path):
    topic.send([event(random.Random(1), "1") for _ in range(60)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a micro-batch; it would merge tiny partitions
    try:
        write_lake(topic.batch(), 0, str(tmp_path / "lake"), rows_per_file=10)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = list((tmp_path / "lake").rglob("*.parquet"))
    assert len(files) > 1 and read_lake(spark, str(tmp_path / "lake")).count() == 60


def test_bad_records(spark, topic, tmp_path):
    good = event(random.Random(1), "1")
    topic.send([b"not json", b"[1]", good, {**good, "fuel_prc": "lots", "mission_id": 3}])
    parsed = topic.batch().orderBy("seq").collect()
    assert parsed[0]["mission_id"] is None and parsed[0]["coord_x"] is None
    assert parsed[3]["fuel_prc"] is None and parsed[3]["mission_id"] == "3"
    assert malformed(topic.batch()).count() == 2
    drain(J.run_lake(topic.stream(), str(tmp_path / "lake"), str(tmp_path / "c"), J.DRAIN))
    assert read_lake(spark, str(tmp_path / "lake")).count() == 4


def test_bad_records_are_no_ships(spark, topic, tmp_path):
    good = event(random.Random(1), "1") | {"mission_status": None}
    topic.send([good | {"ship_id": "A"}, b"not json", b"[1]", b"{}", good | {"ship_id": None}])
    batch = topic.batch()
    assert rows(radar_latest(batch).select("ship_id")) == [("A",), ("UNKNOWN",)]
    assert rows(radar_transitions(batch).select("ship_id")) == [("A",), ("UNKNOWN",)]
    store = TableStore(spark, str(tmp_path / "tables"))
    drain(J.run_radar(topic.stream(), store, str(tmp_path / "c2"), J.DRAIN))
    assert rows(store.read("radar_latest").select("ship_id")) == [("A",), ("UNKNOWN",)]
    drain(J.run_transitions(topic.stream(), str(tmp_path / "log"), str(tmp_path / "c3"), J.DRAIN))
    assert rows(spark.read.parquet(str(tmp_path / "log")).select("ship_id")) == [("A",), ("UNKNOWN",)]
    rejects = str(tmp_path / "rejects")
    drain(J.run_telemetry(topic.stream(), str(tmp_path / "c1"), str(tmp_path / "lake"), J.DRAIN, rejects))
    assert sorted(bytes(r["value"]) for r in spark.read.parquet(rejects).collect()) == [b"[1]", b"not json", b"{}"]
    assert read_lake(spark, str(tmp_path / "lake")).count() == 2


def test_sample_event(spark, table):
    value = '{"timestamp":"2025-10-11T10:45:22.345Z","mission_id":3,"coord_x":42.0,"coord_y":24.0,"fuel_prc":99.8}'
    row = parse_telemetry(table([(value,)], "value string")).first()
    assert (row["mission_id"], row["coord_x"], row["fuel_prc"], row["ship_id"]) == ("3", 42.0, 99.8, None)


def test_gauges(table):
    full = {n: 1.0 for n in C.TELEMETRY_NUMBERS}
    schema = "seq bigint, ship_id string, mission_id string, status string, mission_status string, " + ", ".join(f"{n} double" for n in C.TELEMETRY_NUMBERS)

    def frame(*events):
        return table([{"seq": i, "ship_id": "S", "mission_id": "1", **e} for i, e in enumerate(events)], schema)

    samples = {r["metric"]: r["value"] for r in gauge_samples(frame({**full, "status": "repair", "mission_status": None})).collect()}
    assert len(samples) == 12
    assert (samples["ship_repair_flag"], samples["ship_mission_success"], samples["ship_mission_failure"]) == (1.0, 0.0, 0.0)
    assert gauge_samples(frame({**full, "coord_z": None, "status": "OK", "mission_status": None})).count() == 0
    latest = latest_gauges(frame({**full, "status": "OK", "mission_status": "success"}, {**full, "fuel_prc": None, "status": "OK", "mission_status": None}), "seq")
    assert latest.where("metric = 'ship_mission_success'").first()["value"] == 1.0


def test_new_manifest_files_are_seen_once(spark, tmp_path):
    root = tmp_path / "store"
    seen = []

    def run():
        query = J.new_manifest_files(spark, str(root)).writeStream.foreachBatch(lambda b, _: seen.extend(sorted(r["manifest_path"] for r in b.collect())))
        drain(query.option("checkpointLocation", str(tmp_path / "c")).trigger(**J.DRAIN).start())

    for name in ("a", "b"):
        (root / name).mkdir(parents=True)
        (root / name / "m.json").write_text("{}")
        (root / name / "skip.parquet").write_text("")
        run()
    assert seen == ["a/m.json", "b/m.json"]


def test_finished_manifest_files_leave_the_listing(spark, tmp_path):
    root, archive, sizes = tmp_path / "store", tmp_path / "done", []

    def run():
        source = J.new_manifest_files(spark, str(root), max_files=2, archive=str(archive))
        query = source.writeStream.foreachBatch(lambda b, _: sizes.append(sorted(r["manifest_path"] for r in b.collect())))
        drain(query.option("checkpointLocation", str(tmp_path / "c")).trigger(**J.DRAIN).start())

    for lot in (("a", "b", "c"), ("d",), ("e",)):
        for name in lot:
            (root / name).mkdir(parents=True)
            (root / name / "m.json").write_text("{}")
        run()
    assert [len(s) for s in sizes] == [2, 1, 1, 1] and sorted(sum(sizes, [])) == [f"{n}/m.json" for n in "abcde"]
    left = sorted(p.parent.name for p in root.rglob("*.json"))
    assert left in (["d", "e"], ["e"], [])
    assert sorted(p.parent.name for p in archive.rglob("*.json")) == sorted(set("abcde") - set(left))


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        telemetry_source(spark, "carrier pigeon")
    for refused in ({"starting": "latest"}, {"min_partitions": 8}):
        with pytest.raises(ValueError):
            telemetry_source(spark, "files", path="x", **refused)


def test_versions_are_pruned(spark, table, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for v in range(5):
        store.write(table([(v,)], "v int"), "t", v)
    store.prune("t", keep=2)
    assert store.versions("t") == [3, 4] and store.read("t").first()["v"] == 4
    with pytest.raises(FileNotFoundError):
        store.read("nothing")


STATES = struct(ship_id=TEXT, state=TEXT)


def test_bucket_table(spark, table, tmp_path):
    def batch(*pairs):
        return table(list(pairs), STATES)

    kept = BucketTable(spark, str(tmp_path / "t"), ("ship_id",), STATES, buckets=4)
    assert kept.read().count() == 0 and kept.put(batch(), 0) == []
    assert len(kept.put(batch(*[(f"s{i}", "1") for i in range(40)], (None, "n")), 1)) == 4
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("bucket=*/version=*/*.parquet")}
    (touched,) = kept.put(batch(("s3", "2")), 2)
    assert {f.parent.parent.name for f in set((tmp_path / "t").rglob("bucket=*/version=*/*.parquet")) - set(files)} == {f"bucket={touched}"}
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    kept.put(batch(("s3", "lost attempt"), ("s4", "lost")), 3)
    kept.put(batch(("s3", None), (None, "m")), 3)  # the retry starts from what was there before
    old = {f"s{i}": "1" for i in range(40)} | {None: "n", "s3": "2"}
    assert {r.ship_id: r.state for r in kept.read().collect()} == old | {None: "m", "s3": None}
    assert {r.ship_id: r.state for r in kept.read(below=3).collect()} == old
    for v in range(4, 9):
        kept.put(batch(("s3", str(v))), v)
    assert len(list((tmp_path / "t").rglob(f"bucket={touched}/version=*"))) <= 4 and kept.current()[touched] == 8
    assert len(list((tmp_path / "t" / f"bucket={touched}").glob("version=*"))) == 2
    assert len(list((tmp_path / "t" / "_changes").glob("version=*"))) == 2


def test_shared_folder_comes_from_the_session(spark):
    from wakeline.session import shared_dir, work_path

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(shared_dir(spark))


def test_bare_local_session_gets_a_folder_and_a_cluster_does_not():
    from types import SimpleNamespace

    from wakeline.session import shared_dir

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=Context(master))

    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local) != ""
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_processors_run_in_sessions_made_elsewhere(spark, topic, table, tmp_path):
    """The session keeps another state store; the driver's Python process of a processor cannot import this package."""
    store, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(store)
    spark.conf.set(store, default)
    try:
        start = datetime(2025, 1, 1)
        topic.send(list(ticks((1, 1, {}), (1, 5, {"status": "REPAIR"}), (1, 30, {}))))
        drain(J.run_transitions(topic.stream(), str(tmp_path / "log"), str(tmp_path / "c1"), J.DRAIN))
        drain(J.run_reports(topic.stream(), table([(1, 10, start)], MISSIONS), str(tmp_path / "due"), str(tmp_path / "c2"), J.DRAIN))
        assert spark.conf.get(store) == default
    finally:
        spark.conf.set(store, before)
    assert rows(spark.read.parquet(str(tmp_path / "log")).select("seq", "current")) == [(0, "OK"), (1, "REPAIR"), (2, "OK")]
    got = rows(spark.read.parquet(str(tmp_path / "due")).select("report_no", "kind", "status"))
    assert got == [(0, "start", "OK"), (1, "periodic", "REPAIR"), (2, "periodic", "REPAIR"), (3, "periodic", "REPAIR")]


def test_processors_are_sent_as_code():
    sent = []

    class Rows:
        def groupBy(self, key):
            return self

        def transformWithStateInPandas(self, processor, *more):
            sent.append(states.cloudpickle.dumps(processor))

    for processor in (states.StatusChanges(), states.DueReports()):
        states._processed(Rows(), "ship_id", processor, None, "None")
    assert not [s for s in sent if b"wakeline.schemas" in s or b"wakeline.catalogue" in s]
    load = "import pickle, sys; [pickle.loads(bytes.fromhex(s)) for s in sys.argv[1:]]; assert not [m for m in sys.modules if m.startswith('wakeline')]"
    subprocess.run([sys.executable, "-I", "-c", load, *[s.hex() for s in sent]], check=True)
