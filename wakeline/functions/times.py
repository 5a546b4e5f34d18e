"""Instants, durations and the far-future reporting calendar. Times at rest are TIMESTAMP_NTZ in UTC."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

from wakeline import catalogue as C


def instant(value: datetime | str) -> Column:
    """A zone-less timestamp literal."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def epoch() -> Column:
    return instant("1970-01-01 00:00:00")


def before(as_of: datetime | str, window: timedelta) -> Column:
    return instant(as_of) - F.lit(window)


def utc_text_to_ntz(text: Column) -> Column:
    """ISO-8601 text with offset or ``Z`` -> UTC wall-clock time, whatever the session zone; null if unreadable."""
    local = text.try_cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), local)


def duration_hours(started: Column, finished: Column, as_of: datetime | str) -> Column:
    """Hours from start to finish; an open mission is measured to ``as_of``."""
    micros = F.timestamp_diff("MICROSECOND", started, F.coalesce(finished, instant(as_of)))
    return micros.cast("decimal(20,0)") / F.lit(3_600_000_000).cast("decimal(10,0)")


def far_future(ts: Column) -> Column:
    """Shift into the reporting calendar (29 February clamps to 28 where needed)."""
    return ts + F.make_ym_interval(F.lit(C.YEAR_SHIFT), F.lit(0))


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_time_tag(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH-mm-ss'Z'")
