"""Bounded, rounded and averaged numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = float(2**27 + 1)  # cuts a double into two halves whose products with a small integer are exact


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """``x`` limited to [lo, hi]; null stays null although greatest/least skip nulls."""
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def round_fraction(x: Column, digits: int) -> Column:
    """Round a double below 2^53 / 10^digits in size on its exact binary value, ties to even, as Python's ``round`` does.

    Spark's ``round``/``bround`` work on the shortest decimal text of the double (2.675 looks like a tie, though it
    lies below one) and go through BigDecimal. Here the scaled value is a doubtful tie only where the rounded product
    is exactly one; there the sign of the product's error, exact by splitting ``x`` in two, breaks it. All of it stays
    in double arithmetic.
    """
    scale = F.lit(float(10**digits))
    product = x * scale
    spread = x * F.lit(_SPLIT)
    high = spread - (spread - x)
    error = (high * scale - product) + (x - high) * scale
    tie = product - F.floor(product) == F.lit(0.5)
    return F.when(tie, F.rint(product + F.signum(error) * F.lit(0.25))).otherwise(F.rint(product)) / scale


def round_binary(x: Column, digits: int) -> Column:
    """``round_fraction`` for doubles of any size.

    From 2^53 / 10^digits on neighbouring doubles lie further apart than a rounding step, so each is the double nearest
    to its own rounded value.
    """
    return F.when(F.abs(x) < float(2**53) / 10**digits, round_fraction(x, digits)).otherwise(x)


def round_numeric(x: Column, digits: int) -> Column:
    """SQL ``ROUND(numeric, n)``: half away from zero on a decimal."""
    return F.round(x, digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact decimal ``numerator / denominator``; null when the denominator is zero or null."""
    d = denominator.cast("decimal(18,0)")
    return numerator / F.nullif(d, F.lit(0).cast("decimal(18,0)"))


def count_ratio(part: Column, whole: Column) -> Column:
    """Share of two counts as an exact decimal."""
    return ratio(part.cast("decimal(18,0)"), whole)


def distance_from_origin(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def arrived(position: Column, target: Column, speed: float, rtol: float) -> Column:
    """Whether one axis lies within a tick's travel of the target."""
    return F.abs(position - target) <= F.lit(speed) + F.lit(rtol) * F.abs(target)
