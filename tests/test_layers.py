
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wakeline.operators.aggregates import favourite_ship
from wakeline.operators.gates import freshness_gate
from wakeline.operators.upsert import upsert
from wakeline.plans import business as B, refresh as RF, serving as S
from wakeline.schemas import MANIFESTS, MISSION_REPORTS, MISSIONS, SHIP_STATE, land
from wakeline.sources.tables import TableStore

T0, T1, T2 = datetime(2001, 1, 1), datetime(2001, 1, 10), datetime(2001, 1, 20)
MISSION = "mission_id bigint, ship_name string, captain string, target string, report_freq_min int, status string, started_at timestamp_ntz, finished_at timestamp_ntz, updated_at timestamp_ntz"


def mission(i, status="RUNNING", finished=None, updated=T0, ship="S1", captain="C1", target="P1"):
    return (i, ship, captain, target, 2, status, T0, finished, updated)


@pytest.fixture
def domain(spark, table):
    def build(missions, ticks=(), reports=(), manifests=()):
        return {
            "missions": table(missions, MISSION),
            "ship_state": land(table(list(ticks), "mission_id bigint, timestamp timestamp_ntz, ship_condition string, normalized_health_total double, fuel_prc double"), SHIP_STATE),
            "mission_reports": land(table(list(reports), "mission_id bigint, item string, value double"), MISSION_REPORTS),
            "manifests": land(table(list(manifests), "mission_id bigint, manifest_path string, upload_time timestamp_ntz, status string"), MANIFESTS),
        }

    return build


def summaries(d, as_of):
    return RF.bl_rebuild(d["missions"], d["ship_state"], d["mission_reports"], d["manifests"], as_of)


def test_mission_without_ticks_has_zero_uptime_and_null_health(domain):
    row = summaries(domain([mission(1)]), T1)["mission_summary"].first()
    assert (row["total_ticks"], row["avg_health"], row["uptime_ratio"]) == (0, None, 0)
    assert row["mission_duration_hr"] == 9 * 24
    assert row["computed_at"] == T1


def test_averages_are_exact_decimals(domain):
    ticks = [(1, T0, "GOOD", 0.451, 50.0), (1, T1, "BAD", 0.452, 40.0)]
    row = summaries(domain([mission(1)], ticks), T1)["mission_summary"].first()
    assert row["avg_health"] == Decimal("0.4515") and row["uptime_ratio"] == Decimal("0.5")
    assert row["min_fuel_prc"] == Decimal("40.00")


def test_cargo_counts_items_once_and_keeps_null_items_out(domain):
    reports = [(1, "a", 10.0), (1, "a", 30.0), (1, "b", 2.0), (1, None, 6.0)]
    row = summaries(domain([mission(1), mission(2)], reports=reports), T1)["cargo_summary"].orderBy("mission_id").collect()
    assert (row[0]["nb_unique_items"], row[0]["total_value_poko"], row[0]["avg_value"], row[0]["max_item_value"]) == (2, 48, 12, 30)
    assert (row[1]["nb_unique_items"], row[1]["total_value_poko"]) == (0, None)


def test_last_status_is_the_greatest_text(domain):
    manifests = [(1, "p1", T2, "A"), (1, "p2", T1, "Z")]
    row = summaries(domain([mission(1)], manifests=manifests), T1)["manifest_summary"].first()
    assert (row["nb_manifests"], row["last_upload_time"], row["last_status"]) == (2, T2, "Z")


def test_refresh_keeps_the_first_status_unless_told_otherwise(domain):
    old = summaries(domain([mission(1)]), T1)["mission_summary"]
    now = domain([mission(1, "SUCCESS", T2, T2)], [(1, T1, "GOOD", 1.0, 90.0)])
    kept = B.refresh_mission_summary(old, now["missions"], now["ship_state"], T2).first()
    assert (kept["status"], kept["finished_at"], kept["total_ticks"], kept["avg_health"]) == ("RUNNING", None, 0, 1)
    full = B.refresh_mission_summary(old, now["missions"], now["ship_state"], T2, "all").first()
    assert (full["status"], full["finished_at"], full["total_ticks"]) == ("SUCCESS", T2, 1)
    stale = B.stale_statuses(B.refresh_mission_summary(old, now["missions"], now["ship_state"], T2), now["missions"])
    assert rows(stale) == [("RUNNING", "SUCCESS", 1)]


def test_refreshing_everything_equals_a_rebuild(domain):
    before = domain([mission(1), mission(2)], [(1, T0, "GOOD", 0.9, 80.0)])
    now = domain(
        [mission(1, "SUCCESS", T2, T2), mission(2, updated=T2), mission(3, updated=T2)],
        [(1, T0, "GOOD", 0.9, 80.0), (2, T1, "BAD", 0.4, 30.0)],
    )
    got = B.refresh_mission_summary(summaries(before, T1)["mission_summary"], now["missions"], now["ship_state"], T2, "all")
    assert rows(got) == rows(summaries(now, T2)["mission_summary"])


def test_only_changed_or_open_missions_enter_a_refresh(domain):
    old = summaries(domain([mission(9)]), T1)["mission_summary"]
    now = domain([mission(1, "SUCCESS", T0, T0), mission(2, "SUCCESS", T2, T2), mission(3)])
    assert rows(B.changed_missions(now["missions"], old).select("mission_id")) == [(2,), (3,)]
    assert rows(B.changed_missions(now["missions"], old.limit(0)).select("mission_id")) == [(1,), (2,), (3,)]
    cargo = summaries(domain([mission(9)]), T1)["cargo_summary"]
    assert rows(B.cargo_due_missions(now["missions"], cargo, T2).select("mission_id")) == [(2,), (3,)]


def test_incremental_manifests_skip_missions_without_uploads(domain):
    d = domain([mission(1), mission(2)], manifests=[(1, "p", T2, "INGESTED")])
    empty = summaries(d, T1)["manifest_summary"].limit(0)
    assert rows(B.refresh_manifest_summary(empty, d["missions"], d["manifests"], T2).select("mission_id")) == [(1,)]
    assert summaries(d, T2)["manifest_summary"].count() == 2


def test_vanished_destination_stays(domain):
    old = summaries(domain([mission(1, target="OLD")]), T1)
    d = domain([mission(2, target="NEW")])
    new = summaries(d, T2)
    got = B.refresh_planet_summary(old["planet_summary"], d["missions"], new["mission_summary"], new["cargo_summary"], T2)
    assert rows(got.select("planet")) == [("NEW",), ("OLD",)]


def test_marts(domain):
    reports = [(1, "a", 100.0), (2, "b", 50.0)]
    ticks = [(1, T0, "GOOD", 0.9, 80.0), (1, T1, "BAD", 0.4, 30.0)]
    d = domain(
        [
            mission(1, "SUCCESS", T1, ship="S2", captain="C1"),
            mission(2, "FAILURE", T2, ship="S1", captain="C1"),
            mission(3, ship="S3", captain="C2", target="P2"),
        ],
        ticks,
        reports,
    )
    bl = summaries(d, T2)
    marts = RF.sl_rebuild(bl, T2)
    fleet = marts["mart_fleet_kpis"].first()
    assert (fleet["nb_missions_total"], fleet["nb_ships_total"], fleet["total_value_poko"], fleet["avg_value_per_ship"]) == (3, 3, 150, 50)
    assert fleet["avg_uptime_pct"] == Decimal("16.7")  # (0.5 + 0 + 0) / 3: missions without ticks count as 0
    captains = marts["mart_captain_performance"].collect()
    assert [c["captain"] for c in captains] == ["C2", "C1"]  # null value first, as in a descending SQL order
    assert (captains[1]["favorite_ship"], captains[1]["nb_fav_ship_missions"], captains[1]["success_rate"]) == ("S1", 1, Decimal("0.5"))
    ships = {s["ship_name"]: s for s in marts["mart_ship_performance"].collect()}
    assert ships["S2"]["success_rate_pct"] == 100 and ships["S2"]["last_mission_end"] == T1 and ships["S3"]["total_value_poko"] is None
    planets = marts["mart_planet_performance"].collect()
    assert [(p["planet_name"], p["nb_missions_total"]) for p in planets] == [("P1", 2), ("P2", 1)]


def test_fleet_mart_has_one_row_without_missions(domain):
    bl = summaries(domain([]), T1)
    row = S.mart_fleet_kpis(bl["mission_summary"], bl["cargo_summary"], T1).collect()
    assert len(row) == 1 and row[0]["nb_missions_total"] == 0 and row[0]["avg_value_per_ship"] is None


def test_planet_without_summarised_missions_counts_one_empty_row(domain):
    bl = summaries(domain([mission(1)]), T1)
    lonely = bl["planet_summary"].withColumn("planet", F.lit("EMPTY"))
    row = S.mart_planet_performance(lonely, bl["mission_summary"], bl["cargo_summary"], T1).first()
    assert (row["nb_missions_total"], row["success_rate_pct"], row["avg_value_per_ship"], row["avg_value_per_mission"]) == (0, 0, None, None)


def test_favourite_ship_tie_goes_to_the_first_name(domain):
    d = domain([mission(1, ship="B"), mission(2, ship="A"), mission(3, ship="A"), mission(4, ship="B")])
    assert rows(favourite_ship(d["missions"])) == [("C1", "A", 2)]


def test_upsert_rules(table):
    schema = "k int, a string, b string"
    old = table([(1, "a1", "b1"), (2, "a2", "b2")], schema)
    new = table([(2, "A2", None), (3, "A3", "B3")], schema)
    got = upsert(old, new, ["k"], ["b"])
    assert rows(got, "k") == [(1, "a1", "b1"), (2, "a2", None), (3, "A3", "B3")]
    assert rows(upsert(got, new, ["k"], ["b"])) == rows(got)
    assert rows(upsert(old, new, ["k"]), "k") == [(1, "a1", "b1"), (2, "A2", None), (3, "A3", "B3")]


def test_null_keys_match_on_request(table):
    schema = "k string, v int"
    old, new = table([(None, 1), ("a", 1)], schema), table([(None, 2)], schema)
    assert rows(upsert(old, new, ["k"], null_keys=True)) == [(None, 2), ("a", 1)]
    assert upsert(old, new, ["k"]).count() == 3


def test_gate(table):
    df = table([(T1,), (T2,)], "updated_at timestamp_ntz")
    assert freshness_gate(df, "updated_at", T2, timedelta(minutes=30)).collect()[0] == (True, 1)
    assert freshness_gate(df, "updated_at", T2 + timedelta(days=1), timedelta(minutes=30)).collect()[0] == (False, 0)


def test_stored_refresh_rewrites_the_buckets_of_due_missions(spark, domain, tmp_path):
    def known(*more, missions=12):
        done = [mission(i, "SUCCESS", T1, T1) for i in range(1, missions)]
        return domain([*done, *more], reports=[(i, "a", 5.0) for i in range(1, missions + 1)])

    before = known(mission(12, updated=T1))
    tables = RF.store_summaries(spark, str(tmp_path), summaries(before, T1), buckets=8)
    now = known(mission(12, "SUCCESS", T2, T2))
    assert RF.run_bl_refresh(tables, now, T2 + timedelta(days=9), 1) is None
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "mission_summary").rglob("bucket=*/version=*/*.parquet")}
    for _ in range(2):  # a run repeated after a loss starts from what was there before it
        touched = RF.run_bl_refresh(tables, now, T2, 1)
        assert len(touched["mission_summary"]) == len(touched["cargo_summary"]) == 1
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert rows(tables["mission_summary"].read(below=1).select("mission_id", "computed_at")) == [(i, T1) for i in sorted(range(1, 13), key=str)]
    want = RF.bl_refresh({**now, **summaries(before, T1)}, T2)
    for name, table in tables.items():
        assert rows(table.read()) == rows(want[name].select(*table.read().columns)), name
    for version in range(2, 7):
        RF.run_bl_refresh(tables, known(mission(12, "SUCCESS", T2, T2 + timedelta(minutes=version))), T2 + timedelta(minutes=version), version)
    assert all(len(list(b.glob("version=*"))) <= 2 for b in tmp_path.rglob("bucket=*") if "_changes" not in str(b))


def test_kept_marts_equal_a_rebuild(spark, domain, tmp_path):
    """Six runs of changed missions (states, ships, ends that were the latest and are taken back), one of them repeated."""
    rng = random.Random(5)

    def drawn(i):
        done = rng.random() < 0.6
        end = T1 + timedelta(hours=rng.randint(1, 500)) if done else None
        return mission(i, rng.choice(["SUCCESS", "FAILURE"]) if done else "RUNNING", end, ship=rng.choice("ABC"), captain=rng.choice(["C1", "C2"]))

    def facts(missions):
        reports = [(m[0], f"i{k}", rng.choice([1.0, 2.5, 700.25])) for m in missions for k in range(rng.randint(0, 3))]
        bl = summaries(domain(missions, reports=reports), T1)
        return S.mission_facts(bl["mission_summary"], bl["cargo_summary"]), bl

    now = {i: drawn(i) for i in range(1, 25)}
    first, bl = facts(list(now.values()))
    known = {r.mission_id: r for r in first.collect()}
    kept = S.KeptMarts.build(spark, str(tmp_path), first, buckets=4)
    for version in range(1, 7):
        news = [drawn(rng.randint(1, 30)) for _ in range(3)]
        news = list({m[0]: m for m in news}.values())
        now |= {m[0]: m for m in news}
        changed, _ = facts(news)
        for _ in range(2 if version == 4 else 1):
            kept.update(changed, version)
        known |= {r.mission_id: r for r in changed.collect()}
    whole = spark.createDataFrame(list(known.values()), first.schema)
    operations, cargo = whole.drop("total_value_poko"), whole.select("mission_id", "total_value_poko")
    want = RF.sl_rebuild({"mission_summary": operations, "cargo_summary": cargo, "planet_summary": bl["planet_summary"]}, T1)
    for name, mart in kept.marts(bl["planet_summary"], T1).items():
        assert rows(mart) == rows(want[name]), name


def test_averages_of_money_are_rounded_once(domain):
    """15000.00 over 3000001 reports is 0.00499999833: cut to six digits first it would round up to a cent."""
    from wakeline.operators.aggregates import average
    from wakeline.functions.numeric import round_numeric

    d = domain([mission(1)])
    one = d["missions"].select(F.lit("15000.00").cast("decimal(38,2)").alias("value_sum"), F.lit(3000001).cast("bigint").alias("value_n"))
    got = one.select(average("value").alias("mean"), round_numeric(average("value"), 2).alias("cents")).first()
    assert str(got["mean"]).startswith("0.004999998") and got["cents"] == Decimal("0.00")
    assert one.select(average("value").alias("m")).schema["m"].dataType.scale >= 12
