"""The lake by day, and distinct counts that merge."""

import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import rows
from wakeline import catalogue as C
from wakeline.operators.distinct import distinct_counts, distinct_partials, merged_partials, numbered
from wakeline.sinks.days import DayLake

SCHEMA = "seq bigint, timestamp string, mission_id string, ship_id string, status string, mission_status string, " + ", ".join(f"{n} double" for n in C.TELEMETRY_NUMBERS)


def ticks(spark, first, n, days=3, hot=0.3):
    rng = random.Random(first)
    out = []
    for seq in range(first, first + n):
        at = datetime(2025, 1, 1) + timedelta(days=rng.random() * days)
        mission = "7" if rng.random() < hot else str(rng.randint(100, 999))
        out.append({"seq": seq, "timestamp": at.isoformat() + "Z", "mission_id": mission, "ship_id": "S", **{c: 1.0 for c in C.TELEMETRY_NUMBERS}, "status": "OK", "mission_status": None})
    out[0]["timestamp"] = None
    out[1]["timestamp"] = "2025-13-01 nonsense"
    return spark.createDataFrame(out, SCHEMA)


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_closed_days_are_rewritten_by_mission(spark, tmp_path):
    lake, root = DayLake(spark, str(tmp_path)), tmp_path
    assert lake.read().count() == 0 and lake.compact("9999", 5) == []
    batches = [ticks(spark, i * 1000, 1000) for i in range(3)]
    for i, batch in enumerate(batches[:2]):
        lake.write(batch, i)
    lake.write(ticks(spark, 5000, 10), 2)
    lake.write(batches[2], 2)  # a retried batch replaces itself
    assert seqs(lake.read()) == list(range(3000))
    assert lake.compact("2025-01-03", 1, rows_per_file=200) == ["2025-01-01", "2025-01-02"]
    assert lake.closed() == {"2025-01-01": 1, "2025-01-02": 1}
    assert seqs(lake.read()) == list(range(3000))  # the third batch is still open, the first two are read from the rewritten days
    lake.write(ticks(spark, 3000, 500), 3)  # late rows of closed days
    lake.write(batches[0], 0)  # a batch written again after its rows were taken over
    assert seqs(lake.read()) == list(range(3500))
    assert lake.compact("2025-01-03", 3, rows_per_file=200) == ["2025-01-01", "2025-01-02"]
    assert seqs(lake.read()) == list(range(3500)) and lake.compact("2025-01-03", 3) == []
    assert not list(root.glob("open/day=2025-01-0[12]/batch_id=*")) and len(list(root.glob("closed/day=*/upto=*"))) == 2
    assert seqs(lake.read(days=["2025-01-01", "none"])) == seqs(lake.read().where("timestamp < '2025-01-02' or timestamp is null or timestamp like '2025-13%'"))


def test_a_mission_is_found_by_statistics(spark, tmp_path):
    lake = DayLake(spark, str(tmp_path))
    for i in range(3):
        lake.write(ticks(spark, i * 2000, 2000, days=1), i)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge tiny partitions
    try:
        assert lake.compact("2025-01-02", 2, rows_per_file=500) == ["2025-01-01"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = list(tmp_path.glob("closed/day=2025-01-01/upto=2/*.parquet"))
    assert 8 <= len(files) <= 16
    column = pq.read_schema(files[0]).get_field_index("mission_id")
    spans = []
    for f in files:
        groups = pq.ParquetFile(f).metadata
        stats = [groups.row_group(g).column(column).statistics for g in range(groups.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    for mission in ("150", "512", "980"):
        assert sum(low <= mission <= high for low, high in spans) <= 2
    assert sum(low <= "7" <= high for low, high in spans) >= 3  # the hot mission fills files of its own
    one = lake.read("512", ["2025-01-01"])
    assert "PushedFilters: [IsNotNull(mission_id), EqualTo(mission_id,512)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == lake.read().where("mission_id = '512' and timestamp is not null").count()


def test_distinct_counts_merge(spark):
    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.randint(1, 6), rng.choice([1, 5, 32_767, 32_768, 32_769, 100_000, None, rng.randint(1, 200_000)])) for _ in range(4000)]
    df = spark.createDataFrame(data, "k string, month int, v bigint")
    parts = distinct_partials(df, ["k", "month"], F.col("v"))
    want = rows(df.groupBy("k").agg(F.countDistinct("v").alias("n")))
    assert rows(distinct_counts(parts, ["k"])) == want
    halves = [merged_partials(parts.where(c), ["k"]) for c in ("month < 4", "month >= 4", "month between 2 and 5")]
    assert rows(distinct_counts(halves[0].union(halves[1]).union(halves[2]), ["k"])) == want
    assert rows(distinct_counts(parts, ["k", "month"])) == rows(df.where("v is not null").groupBy("k", "month").agg(F.countDistinct("v").alias("n")))


def test_names_keep_their_numbers(table):
    first = numbered(table([("b",), ("a",), (None,), ("b",)], "name string"), "name")
    assert rows(first) == [("a", 1), ("b", 2)]
    assert rows(numbered(table([("b",), ("0",), ("c",)], "name string"), "name", first)) == [("0", 3), ("a", 1), ("b", 2), ("c", 4)]
    assert rows(numbered(table([("x",)], "name string"), "name", first.limit(0))) == [("x", 1)]
