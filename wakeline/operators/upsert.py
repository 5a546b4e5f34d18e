"""Insert-or-update of a batch into a keyed table, as a DataFrame transformation."""

from __future__ import annotations

from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    update_cols: list[str] | tuple[str, ...] | Literal["all"] = "all",
    null_keys: bool = False,
) -> DataFrame:
    """Rows of ``target`` with ``batch`` merged in.

    A new key inserts every column. A known key takes only ``update_cols`` from the batch and keeps the rest. Both
    sides hold a key at most once, so the full outer join shuffles each side once and cannot blow up on a hot key.
    ``null_keys`` lets a null key match a null key, for tables keyed by nullable labels.
    """
    columns = target.columns
    updated = set(columns) if update_cols == "all" else set(update_cols)
    old = target.select(*[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_old"))
    new = batch.select(*[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_new"))

    def same(key: str) -> Column:
        left, right = F.col(f"_old_{key}"), F.col(f"_new_{key}")
        return left.eqNullSafe(right) if null_keys else left == right

    def choose(c: str) -> Column:
        if c in keys:
            return F.coalesce(f"_old_{c}", f"_new_{c}").alias(c)
        if c in updated:
            return F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)
        return F.when(F.col("_old"), F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}")).alias(c)

    matched = reduce(lambda a, b: a & b, [same(k) for k in keys])
    return old.join(new, matched, "full_outer").select(*[choose(c) for c in columns])
