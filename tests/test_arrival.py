"""Arrival-order operators: results do not depend on chunk or slice size, whatever share one key holds."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wakeline.operators.arrival import latest_per_key, number_by_arrival
from wakeline.operators.skew import hot_keys, sliced_join, with_slice
from wakeline.plans.radar import last_known, mission_outcomes, radar_latest, radar_transitions

EVENT = "seq bigint, ship_id string, status string, mission_status string"


def events(n=600, seed=3):
    """A third of all events belong to one ship; some come without ship id or status."""
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        ship = "HOT" if rng.random() < 0.34 else rng.choice(["A", "B", "C", "D", None, ""])
        end = rng.random() < 0.08
        out.append((seq * 3 + rng.randrange(3), ship, rng.choice(["OK", "OK", "REPAIR", None]), rng.choice(["SUCCESS", "FAILURE"]) if end else None))
    return out


def replay(stream):
    """What one consumer sees, event by event."""
    known, latest, log = {}, {}, []
    for seq, ship, status, end in stream:
        ship = ship or "UNKNOWN"
        if end in ("SUCCESS", "FAILURE"):
            known.pop(ship, None)
            latest.pop(ship, None)
            continue
        latest[ship] = seq
        now = status or "OK"
        if known.get(ship) != now:
            log.append((ship, seq, known.get(ship), now))
            known[ship] = now
    return known, latest, log


@pytest.mark.parametrize("chunk", [1, 7, 100, 10_000])
def test_transitions_equal_replay(table, chunk):
    stream = events()
    df = radar_transitions(table(stream, EVENT), chunk=chunk).drop("marker")
    assert rows(df, "seq") == sorted(replay(stream)[2], key=lambda r: r[1])


def test_transitions_continue_from_carried_state(table):
    stream = events()
    first, second = stream[:250], stream[250:]
    carried = last_known(table(first, EVENT)).where("state is not null")
    got = radar_transitions(table(second, EVENT), chunk=40, carried=carried).drop("marker")
    later = [r for r in replay(stream)[2] if r[1] >= second[0][0]]
    assert rows(got, "seq") == sorted(later, key=lambda r: r[1])


def test_latest_equals_replay(table):
    stream = events()
    df = radar_latest(table(stream, EVENT)).select("ship_id", "seq")
    assert dict(rows(df, "ship_id")) == replay(stream)[1]


GOLDEN = [
    ([("A", "OK", None), ("A", "OK", None), ("A", "REPAIR", None)], [("A", "REPAIR")], ["OK", "REPAIR"]),
    ([("A", "OK", None), ("A", "OK", "SUCCESS")], [], ["OK"]),
    ([("A", "OK", None), ("A", "OK", "FAILURE"), ("A", "OK", None)], [("A", "OK")], ["OK", "OK"]),
    ([(None, "OK", None)], [("UNKNOWN", "OK")], ["OK"]),
    ([("A", None, None), ("A", "OK", None)], [("A", "OK")], ["OK"]),
]


@pytest.mark.parametrize("stream,latest,log", GOLDEN)
def test_golden(table, stream, latest, log):
    df = table([(i, *e) for i, e in enumerate(stream)], EVENT)
    assert rows(radar_latest(df).select("ship_id", "status")) == latest
    assert [r["current"] for r in radar_transitions(df).orderBy("seq").collect()] == log


def test_outcome_is_the_first_terminal_event(table):
    df = table([(3, "1", "t3", "FAILURE"), (1, "1", "t1", None), (2, "1", "t2", "SUCCESS"), (4, "2", "t4", None)],
               "seq bigint, mission_id string, timestamp string, mission_status string")
    assert rows(mission_outcomes(df)) == [("1", 2, "SUCCESS", "t2")]


@pytest.mark.parametrize("chunk", [1, 10, 1000])
def test_numbering_is_dense_in_arrival_order(table, chunk):
    ids = sorted(random.Random(1).sample(range(5000), 300))
    df = number_by_arrival(table([(i,) for i in ids], "id bigint").repartition(5), "id", "no", chunk)
    assert rows(df.select("id", "no"), "id") == list(zip(ids, range(1, 301)))


@pytest.mark.parametrize("per_slice", [1, 10, 10_000])
def test_sliced_join_equals_plain_join(table, per_slice):
    rng = random.Random(5)
    big = [("HOT" if rng.random() < 0.4 else f"k{rng.randrange(30)}", i) for i in range(400)] + [(None, 1000), ("gone", 1001)]
    large, small = table(big, "k string, v bigint"), table([("HOT", 1)] + [(f"k{i}", i) for i in range(40)], "k string, w bigint")
    got = sliced_join(large, small, "k", F.col("v"), per_slice)
    assert rows(got.select("k", "v", "w")) == rows(large.join(small, "k").select("k", "v", "w"))
    for how in ("left_semi", "left_anti"):
        got = sliced_join(large, small.where("k <> 'k3'").select("k"), "k", F.col("v"), per_slice, how)
        assert rows(got.select("k", "v")) == rows(large.join(small.where("k <> 'k3'"), "k", how).select("k", "v"))


def test_hot_key_is_spread_and_nothing_is_lost(table):
    df = table([("HOT", i) for i in range(300)] + [("cold", i) for i in range(20)], "k string, v bigint")
    assert rows(hot_keys(df, "k", 100)) == [("HOT", 3)]
    sliced = with_slice(df, "k", F.col("v"), 100)
    assert sliced.count() == 320
    assert [r["_slice"] for r in sliced.where("k = 'HOT'").select("_slice").distinct().orderBy("_slice").collect()] == [0, 1, 2]
    assert sliced.where("k = 'cold'").select("_slice").distinct().collect()[0]["_slice"] == 0


def test_equal_rows_of_a_hot_key_are_spread(table):
    df = table([("HOT", 1)] * 400, "k string, v bigint").repartition(16)
    assert with_slice(df, "k", F.col("v"), 50).select("_slice").distinct().count() > 3
    assert sliced_join(df, table([("HOT", 2)], "k string, w bigint"), "k", F.col("v"), 50).count() == 400


def test_rows_without_a_key_are_sliced_too(table):
    df = table([(None, i) for i in range(300)] + [("a", 1000)], "k string, v bigint")
    sliced = with_slice(df, "k", F.col("v"), 100)
    assert sliced.count() == 301 and sliced.where("k is null").select("_slice").distinct().count() == 3


def test_latest_per_key_takes_the_whole_row(table):
    df = table([("a", 1, "x", None), ("a", 5, None, 2.0), ("b", 2, "y", 3.0)], "k string, seq bigint, s string, d double")
    assert rows(latest_per_key(df, ["k"], "seq")) == [("a", 5, None, 2.0), ("b", 2, "y", 3.0)]


def test_numbers_of_requests_far_apart(spark):
    """Ids millions to 2^40 apart: every request is a chunk of its own, and no window holds all chunks."""
    from wakeline.operators.arrival import number_by_arrival

    ids = [i * 5_000_000 for i in range(300)] + [2**45 + i * 2**37 for i in range(40)] + [-5, 2**62]
    got = {r.id: r.number for r in number_by_arrival(spark.createDataFrame([(i,) for i in reversed(ids)], "id bigint"), "id").collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids), 1)}


def test_ranks_are_dense_over_all_ranges(spark):
    from wakeline.operators.aggregates import ranked

    df = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("v"), F.format_string("%04d", "id").alias("name"))
    got = ranked(df, F.desc_nulls_first("v"), F.col("name")).collect()
    plain = sorted(df.collect(), key=lambda r: (r.v is not None, -(r.v or 0), r.name))
    assert [(r["rank"], r.v, r.name) for r in sorted(got, key=lambda r: r["rank"])] == [(i, r.v, r.name) for i, r in enumerate(plain, 1)]
    assert ranked(df.limit(0), F.col("name")).count() == 0
