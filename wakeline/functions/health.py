"""Vehicle health from telemetry readings, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wakeline import catalogue as C
from wakeline.functions.numeric import round_fraction

SCORES = ("motor_health", "engine_health", "core_health", "fuel_health")


def band_score(reading: Column, centre: float) -> Column:
    """1 at ``centre``, falling linearly to 0 at zero and at twice the centre. It cannot exceed 1."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(reading - F.lit(centre)) / F.lit(centre))


def band_broken(reading: Column, low: float, high: float) -> Column:
    return (reading < low) | (reading > high)


def fuel_score(reading: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), reading / F.lit(100.0)))


def fuel_broken(reading: Column) -> Column:
    return reading <= C.FUEL_BROKEN_AT


def subsystem_scores(df: DataFrame) -> DataFrame:
    """Add unrounded ``<name>_score`` and ``<name>_broken`` for each subsystem; a missing reading counts as 0."""
    added = {}
    for name, (field, centre, low, high) in C.SUBSYSTEMS.items():
        reading = _reading(df, field)
        added[f"{name}_score"] = band_score(reading, centre)
        added[f"{name}_broken"] = band_broken(reading, low, high)
    fuel = _reading(df, C.FUEL_FIELD)
    added["fuel_score"], added["fuel_broken"] = fuel_score(fuel), fuel_broken(fuel)
    return df.withColumns(added)


def score_health(df: DataFrame) -> DataFrame:
    """Add the four rounded scores, ``normalized_health_total`` and ``ship_condition``.

    Thresholds compare the unrounded total; rounding happens in the output only. Readings are made non-null first, so
    plain greatest/least bound them and the generated code stays free of null checks.
    """
    work = subsystem_scores(df)
    status = F.coalesce(F.col("status"), F.lit(C.OK)) if "status" in df.columns else F.lit(C.OK)
    part = F.col("malfunctioned_component") if "malfunctioned_component" in df.columns else F.lit("")
    malfunction = F.coalesce(part, F.lit("")) != ""
    broken = reduce(lambda a, b: a | b, [F.col(f"{n}_broken") for n in C.HEALTH_WEIGHTS])
    weighted = reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"{n}_score") for n, w in C.HEALTH_WEIGHTS.items()])

    work = work.withColumn("_total", F.least(F.lit(1.0), weighted))
    total = F.col("_total")
    ladder = F.when(status == C.REPAIR, "REPAIRING").when(
        (status == C.FAILURE) | broken | malfunction, "UNOPERATIONAL"
    )
    for least, label in C.CONDITION_STEPS:
        ladder = ladder.when(total >= least, label)
    capped = (
        F.when(status == C.REPAIR, F.least(total, F.lit(C.REPAIR_CAP)))
        .when(status == C.FAILURE, F.lit(0.0))
        .when(malfunction & ~broken, F.least(total, F.lit(C.MALFUNCTION_CAP)))
        .otherwise(total)
    )
    scores = {f"{n}_health": round_fraction(F.col(f"{n}_score"), 3) for n in C.HEALTH_WEIGHTS}
    scored = work.withColumns(
        {
            **scores,
            "normalized_health_total": round_fraction(capped, 3),
            "ship_condition": ladder.otherwise(C.LOWEST_CONDITION),
        }
    )
    return scored.drop("_total", *[f"{n}_{s}" for n in C.HEALTH_WEIGHTS for s in ("score", "broken")])


def _reading(df: DataFrame, field: str) -> Column:
    return F.coalesce(F.col(field), F.lit(0.0)) if field in df.columns else F.lit(0.0)
