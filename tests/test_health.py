"""Golden health cases (FIXTURES.md 4.1) and binary rounding."""

import random

import pytest
from pyspark.sql import functions as F

from wakeline.functions.health import score_health
from wakeline.functions.numeric import clamp, round_binary
from tests.conftest import rows

READINGS = "motor_temp_c double, engine_pressure_kpa double, power_core_temp_c double, fuel_prc double, status string, malfunctioned_component string"

GOLDEN = [
    ((90.0, 325.0, 600.0, 100.0, "OK", None), "GOOD", 1.0),
    ((90.0, 325.0, 600.0, 100.0, "REPAIR", "x"), "REPAIRING", 0.4),
    ((90.0, 325.0, 600.0, 100.0, "FAILURE", None), "UNOPERATIONAL", 0.0),
    ((90.0, 325.0, 600.0, 100.0, "OK", "x"), "UNOPERATIONAL", 0.3),
    ((90.0, 325.0, 600.0, 5.0, "OK", None), "UNOPERATIONAL", 0.905),
    ((45.0, 325.0, 600.0, 100.0, "OK", None), "GOOD", 0.85),
    ((180.0, 325.0, 600.0, 100.0, "OK", None), "MID", 0.7),
    ((180.0, 600.0, 600.0, 50.0, "OK", None), "BAD", 0.396),
    ((180.0, 600.0, 950.0, 100.0, "OK", None), "CRITICAL", 0.271),
    ((-1.0, 325.0, 600.0, 100.0, "OK", None), "UNOPERATIONAL", 0.7),
    ((None, None, None, None, None, None), "UNOPERATIONAL", 0.0),
    ((90.0, 325.0, 600.0, 100.0, "SUCCESS", None), "GOOD", 1.0),
    ((90.0, 325.0, 600.0, 100.0, "OK", ""), "GOOD", 1.0),
]


@pytest.mark.parametrize("reading,condition,total", GOLDEN)
def test_golden(table, reading, condition, total):
    row = score_health(table([reading], READINGS)).first()
    assert (row["ship_condition"], row["normalized_health_total"]) == (condition, total)


def test_absent_columns_count_as_broken(table):
    row = score_health(table([("M",)], "mission_id string")).first()
    assert (row["ship_condition"], row["normalized_health_total"]) == ("UNOPERATIONAL", 0.0)


def test_threshold_uses_the_unrounded_total(table):
    # 0.3 * motor + 0.3 + 0.3 + 0.1 * fuel lies just below 0.8 and rounds to 0.8
    motor = 90.0 * (1 - 0.3332)
    row = score_health(table([(motor, 325.0, 600.0, 0.2 * 100, "OK", None)], READINGS)).first()
    assert (row["ship_condition"], row["normalized_health_total"]) == ("GOOD" if 0.3 * 0.6668 + 0.6 + 0.02 >= 0.8 else "MID", 0.82)
    low = score_health(table([(90.0 * 0.59985, 325.0, 600.0, 20.0, "OK", None)], READINGS)).first()
    assert (low["ship_condition"], low["normalized_health_total"]) == ("MID", 0.8)


def test_rounding_equals_python(spark, table):
    rng = random.Random(7)
    values = [k / 16 for k in range(-64, 64)] + [2.675, -2.675, 0.0045, 0.0005, 1e15 + 0.3, 1e300, 0.0]
    values += [rng.randrange(1 << 22) / 2000 for _ in range(20000)] + [rng.uniform(-1e6, 1e6) for _ in range(20000)]
    # every size up to where doubles are whole, both signs, and the ends of each power of two
    for power in range(36, 56):
        some = [rng.uniform(2.0**power, 2.0 ** (power + 1)) for _ in range(400)] + [2.0**power, 2.0**power + 0.125, 2.0**power - 0.375]
        values += [v * sign for v in some for sign in (1, -1)]
    values += [1099511627776.123, 8796093022208.127, -8796093022208.127]
    df = table([(v, round(v, 2), round(v, 3)) for v in values], "x double, two double, three double")
    x = F.col("x")
    assert df.where((round_binary(x, 2) != F.col("two")) | (round_binary(x, 3) != F.col("three"))).count() == 0


def test_clamp_keeps_null(table):
    df = table([(None,), (-1.0,), (0.4,), (9.0,)], "x double").select(clamp(F.col("x")).alias("y"))
    assert rows(df) == [(None,), (0.0,), (0.4,), (1.0,)]


def test_generated_code_stays_compilable(spark, table):
    """HotSpot never compiles a method above 8000 bytes: scoring beyond that runs interpreted."""
    df = score_health(table([GOLDEN[0][0]], READINGS))
    plan = df._jdf.queryExecution().sparkPlan()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = score_health(table([GOLDEN[0][0]], READINGS).repartition(2))._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000
