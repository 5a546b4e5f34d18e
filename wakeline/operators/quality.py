"""Declared constraints as distributed checks. Each returns violations ``(table, check, key, n)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wakeline import catalogue as C
from wakeline.operators import keys as K
from wakeline.schemas import TEXT_WIDTHS


def _violations(df: DataFrame, table: str, check: str, key: Column, n: str | Column = "n") -> DataFrame:
    count = F.col(n) if isinstance(n, str) else n
    return df.select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), key.cast("string").alias("key"), count.alias("n")
    )


def _counted(df: DataFrame, table: str, check: str, conditions: dict[str, Column]) -> DataFrame:
    """One pass counting every condition, then one row per condition that was met."""
    if not conditions:
        return df.limit(0).select(*[F.lit("").alias(c) for c in ("table", "check", "key")], F.lit(0).alias("n"))
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    long = counts.unpivot([], list(conditions), "key", "n").where("n > 0")
    return _violations(long, table, check, F.col("key"))


def primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    dup = K.duplicate_keys(df, keys)
    return _violations(dup, table, "primary_key", F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def foreign_key(children: DataFrame, parents: DataFrame, table: str, key: str) -> DataFrame:
    return _violations(K.orphan_keys(children, parents, key), table, "foreign_key", F.col(key))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _counted(df, table, "not_null", {c: F.col(c).isNull() for c in columns})


def numeric_overflow(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Values present but not representable in the declared decimal type."""
    have = set(df.columns)
    bad = {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema.fields
        if isinstance(f.dataType, T.DecimalType) and f.name in have
    }
    return _counted(df, table, "numeric_overflow", bad)


def text_width(df: DataFrame, table: str, widths: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    widths = TEXT_WIDTHS.get(table, {}) if widths is None else widths
    bad = {c: ~F.length(c).between(low, high) for c, (low, high) in widths.items() if c in df.columns}
    return _counted(df, table, "text_width", bad)


def status_domain(df: DataFrame, table: str, column: str = "status", allowed: tuple[str, ...] = C.MISSION_STATES) -> DataFrame:
    outside = df.where(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return _violations(outside, table, "status_domain", F.col(column))


def single_row(df: DataFrame, table: str) -> DataFrame:
    """A violation when ``df`` has any number of rows but one."""
    n = df.agg(F.count(F.lit(1)).alias("n")).where("n <> 1")
    return _violations(n, table, "single_row", F.lit("rows"))


def checksum_mismatch(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Manifests whose recorded report checksum differs from the file's, or whose file is absent.

    ``files``: ``object_key, sha256`` (``sources.files.file_hashes``). Where both sides have ``object``
    (``reports.report_objects``), which names the file as its key does, they meet by it.
    """
    by = ("object", "object") if "object" in manifests.columns and "object" in files.columns else ("mission_file", "object_key")
    joined = manifests.join(files, manifests[by[0]] == files[by[1]], "left")
    bad = joined.where(~F.col("checksum_mission").eqNullSafe(F.col("sha256")))
    return _violations(bad, "manifests", "checksum", F.col("mission_file"), F.lit(1).cast("bigint"))
