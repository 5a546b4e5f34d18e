"""Telemetry rows as metric samples and as topic records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wakeline import catalogue as C
from wakeline.functions.text import encode_json, flag
from wakeline.operators.upsert import upsert

METRIC_KEYS = ["metric", "ship_id", "mission_id"]


def _gauge_columns() -> dict[str, Column]:
    plain = {name: F.col(field) for name, _, field in C.GAUGES}
    return {**plain, **{name: flag(F.col(field), value) for name, _, field, value in C.FLAG_GAUGES}}


def _complete_rows(telemetry: DataFrame) -> DataFrame:
    """Rows with all nine readings: a row lacking one publishes nothing at all."""
    return telemetry.where(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for _, _, f in C.GAUGES]))


def _to_long(wide: DataFrame) -> DataFrame:
    names = [g[0] for g in (*C.GAUGES, *C.FLAG_GAUGES)]
    long = wide.unpivot(["ship_id", "mission_id"], names, "metric", "value")
    helps = {g[0]: g[1] for g in (*C.GAUGES, *C.FLAG_GAUGES)}
    table = F.create_map(*[F.lit(x) for pair in helps.items() for x in pair])
    return long.select("metric", table[F.col("metric")].alias("help"), "ship_id", "mission_id", "value")


def gauge_samples(telemetry: DataFrame) -> DataFrame:
    """Twelve samples ``metric, help, ship_id, mission_id, value`` per complete telemetry row."""
    return _to_long(_complete_rows(telemetry).select("ship_id", "mission_id", *_aliased(_gauge_columns())))


def latest_gauges(telemetry: DataFrame, order: str | Column) -> DataFrame:
    """Latest sample per metric, ship and mission.

    Every complete row carries all twelve gauges, so the latest row per (ship, mission) is taken first and unpivoted
    afterwards. All twelve are doubles: the aggregation stays a hash aggregate with map-side merging.
    """
    gauges = _gauge_columns()
    wide = _complete_rows(telemetry).select("ship_id", "mission_id", (F.col(order) if isinstance(order, str) else order).alias("_order"), *_aliased(gauges))
    last = wide.groupBy("ship_id", "mission_id").agg(*[F.max_by(g, "_order").alias(g) for g in gauges])
    return _to_long(last)


def merge_gauges(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Fold a batch of latest samples into the current ones: the batch wins."""
    return upsert(current, batch, METRIC_KEYS, null_keys=True)


def to_topic_records(events: DataFrame, key: str = "ship_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """Keyed UTF-8 JSON records ``key, value``; nulls stay in the JSON.

    JSON has no NaN and no infinity: an event with such a number has a null value, which ``split_encodable`` sets aside.
    """
    fields = [c for c in events.columns if c not in drop]
    numbers = [c for c, kind in events.select(*fields).dtypes if kind in ("double", "float")]
    odd = [F.coalesce(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), F.lit(False)) for c in numbers]
    value = encode_json(*fields)
    return events.select(F.col(key).alias("key"), (F.when(~reduce(lambda a, b: a | b, odd), value) if odd else value).alias("value"))


def split_encodable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a value, and a dead-letter frame whose value is a ``serialization_error`` document."""
    good = records.where(F.col("value").isNotNull())
    why = F.to_json(F.struct(F.lit("value could not be encoded").alias("serialization_error")))
    return good, records.where(F.col("value").isNull()).withColumn("value", why)


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]
