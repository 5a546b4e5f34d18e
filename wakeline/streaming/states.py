"""Stateful operators of the streams: what has to be remembered of a ship or mission lives in Spark's keyed state.

A task holds the rows that one key has in one micro-batch (narrow columns only); the source's limit per trigger bounds
them. State is one value a ship, and one value a bucket of missions with their plans and open periods.

Spark also runs a processor once in a Python process of the driver, which does not see what executors are given to
import. Processors are therefore sent as code, and use nothing of this package but what stands in this module.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wakeline import catalogue as C
from wakeline.functions.health import score_health
from wakeline.functions.text import status_marker
from wakeline.functions.times import utc_text_to_ntz
from wakeline.plans.radar import is_terminal, named_ships, remembered_status
from wakeline.schemas import DOUBLE, LONG, TEXT, struct
from wakeline.session import SETTINGS

#: Where a record arrived; in this order records of any partitions are put.
PLACE = ("arrived", "partition", "offset")


def arrival_number() -> Column:
    """``PLACE`` as one number, which an aggregation can hold in place: milliseconds, six digits, eighteen digits."""
    arrived, partition, offset = (F.col(c).cast(f"decimal({n},0)") for c, n in zip(PLACE, (14, 6, 18)))
    return arrived * F.lit("1" + "0" * 24).cast("decimal(25,0)") + partition * F.lit("1" + "0" * 18).cast("decimal(19,0)") + offset


#: Keyed state of processors needs this store; sessions made elsewhere have another one.
_STORE = "spark.sql.streaming.stateStore.providerClass"


def start_stateful(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a query with a processor, under the state store it needs. A query keeps the settings it was started with."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, SETTINGS[_STORE])
    try:
        return writer.start()
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def _processed(rows: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType, time_mode: str) -> DataFrame:
    here = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(here)
    try:
        return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", time_mode)
    finally:
        cloudpickle.unregister_pickle_by_value(here)


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """All rows of a key in a micro-batch in arrival order."""
    frame = pd.concat(list(rows), ignore_index=True)
    return frame.iloc[np.lexsort([frame[c].to_numpy() for c in reversed(PLACE)])]


def _none(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


_KNOWN_TYPE = struct(status=TEXT)


class StatusChanges(StatefulProcessor):
    """Changes of the status a ship is known by; a terminal event clears what is known, and the state with it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("status", _KNOWN_TYPE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _sorted(rows)
        held = self.known.get()
        known = held[0] if held else None
        current = _none(frame["current"])
        previous = [known, *current[:-1]]
        changed = [i for i, (a, b) in enumerate(zip(previous, current)) if b is not None and a != b]
        if current[-1] is None:
            self.known.clear()
        elif current[-1] != known:
            self.known.update((current[-1],))
        if changed:
            yield pd.DataFrame(
                {
                    "ship_id": key[0],
                    "seq": frame["offset"].to_numpy()[changed],
                    "previous": pd.Series([previous[i] for i in changed], dtype=object),
                    "current": [current[i] for i in changed],
                }
            )

    def close(self) -> None:
        pass


def status_changes(telemetry: DataFrame) -> DataFrame:
    """Streaming ``ship_id, seq, previous, current, marker`` from parsed telemetry with its place of arrival."""
    events = named_ships(telemetry).select("ship_id", *PLACE, remembered_status().alias("current"))
    changes = _processed(events, "ship_id", StatusChanges(), struct(ship_id=TEXT, seq=LONG, previous=TEXT, current=TEXT), "None")
    return changes.withColumn("marker", status_marker(F.col("current")))


#: What a report shows of a tick.
_NUMBERS = tuple(C.TELEMETRY_NUMBERS)
STATE = ("timestamp", "ship_id", *_NUMBERS, "status")
_STATE_TYPE = struct(timestamp=TEXT, ship_id=TEXT, **dict.fromkeys(_NUMBERS, DOUBLE), status=TEXT)
#: Missions are dealt into so many keys, each of which holds its missions' state in one value. A query keeps its number.
BUCKETS = 512
#: Reports handed over at once.
_ROWS = 50_000
#: The period of an end that has not come.
_NEVER = np.iinfo(np.int64).max
_HELD_TYPE = struct(plans=T.BinaryType(), open=T.BinaryType())
# begin and period in milliseconds; the next report's number; the end's period
_PLANS = pa.schema([(c, pa.int64()) for c in ("mission_id", "begin", "period", "next", "ending")])
_OPEN = pa.schema(
    [("mission_id", pa.int64()), ("slot", pa.int64())] + [(c, pa.float64() if c in _NUMBERS else pa.string()) for c in STATE]
)


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(pa.Table.from_pandas(frame, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(content: bytes | None, schema: pa.Schema) -> pd.DataFrame:
    table = schema.empty_table() if content is None else pa.ipc.open_stream(bytes(content)).read_all()
    return table.to_pandas()


class DueReports(StatefulProcessor):
    """The reports of missions: at the first tick, at every report time that the watermark has passed, at the end.

    The key is a bucket of missions, which are worked on together. A period's last state is kept until the watermark
    closes the period; then the bucket's timer sends the report, and those of the silent periods behind it as they fall
    due, whether or not the mission says anything more. Once a mission has ended and its last open period is closed, nothing but the end is remembered.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("missions", _HELD_TYPE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _sorted(rows)
        frame = frame.iloc[np.argsort(frame["mission_id"].to_numpy(), kind="stable")].reset_index(drop=True)
        plans, known = self._load()
        ids, first = np.unique(frame["mission_id"].to_numpy(), return_index=True)
        first = first[~np.isin(ids, plans["mission_id"].to_numpy())]
        fresh = frame.loc[first, ["mission_id", "begin", "period"]].assign(next=1, ending=_NEVER)
        plans = pd.concat([plans, fresh]).astype(np.int64).sort_values("mission_id", ignore_index=True)
        yield from self._frames(frame.loc[first], 0, "start")

        at = np.searchsorted(plans["mission_id"].to_numpy(), frame["mission_id"].to_numpy())
        begin, period, ending = (plans[c].to_numpy()[at] for c in ("begin", "period", "ending"))
        slot = np.where(period > 0, (frame["at"].to_numpy() - begin) // np.maximum(period, 1), 0)
        live = ending == _NEVER
        ends = np.flatnonzero(live & frame["terminal"].eq(True).to_numpy())
        ends = ends[np.unique(at[ends], return_index=True)[1]]
        final = frame.loc[ends].drop(columns="status").rename(columns={"mission_status": "status"})
        yield from self._frames(final, slot[ends] + 1, "final")
        plans.loc[at[ends], "ending"] = slot[ends]

        until = np.full(len(plans), len(frame))
        until[at[ends]] = ends
        ticks = frame.assign(slot=slot)[live & (period > 0) & (np.arange(len(frame)) < until[at])]
        ticks = ticks[_OPEN.names].drop_duplicates(["mission_id", "slot"], keep="last")
        if len(ticks):
            known = (pd.concat([known, ticks]) if len(known) else ticks).drop_duplicates(["mission_id", "slot"], keep="last")
        yield from self._due(plans, known, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._due(*self._load(), timerValues)

    def _load(self) -> tuple[pd.DataFrame, pd.DataFrame]:
        held = self.held.get()
        plans, known = held if held else (None, None)
        return _unpacked(plans, _PLANS), _unpacked(known, _OPEN)

    def _due(self, plans: pd.DataFrame, known: pd.DataFrame, timers) -> Iterator[pd.DataFrame]:
        """Periodic reports up to the watermark; sets the timer of the next one. ``plans`` are in order of their missions."""
        watermark = timers.getCurrentWatermarkInMs()
        begin, period, number, ending = (plans[c].to_numpy() for c in ("begin", "period", "next", "ending"))
        over = (period == 0) | (ending < number)
        upto = (watermark - begin) // np.maximum(period, 1) if watermark > 0 else number - 1
        upto = np.minimum(upto, ending)
        due = ~over & (upto >= number)

        # A period's last state is shown by the report that closes it and by those up to the next period with ticks.
        known = known.iloc[np.lexsort([known["slot"].to_numpy(), known["mission_id"].to_numpy()])]
        at = np.searchsorted(plans["mission_id"].to_numpy(), known["mission_id"].to_numpy())
        slot = known["slot"].to_numpy()
        following = np.full(len(known), _NEVER)
        following[:-1] = np.where(at[1:] == at[:-1], slot[1:], _NEVER)
        low, high = np.maximum(slot + 1, number[at]), np.minimum(following, upto[at])
        counts = np.where(due[at], np.maximum(high - low + 1, 0), 0)
        yield from self._spread(known, low, counts)

        number = np.where(due, upto + 1, number)
        over = (period == 0) | (ending < number)
        known = known[~(due[at] & (following < upto[at])) & ~over[at]]  # the state before the next report stays
        self.held.update((_packed(plans.assign(next=number), _PLANS), _packed(known, _OPEN)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not over.all():
            self.handle.registerTimer(max(int((begin + number * period)[~over].min()), watermark + 1))

    def _spread(self, known: pd.DataFrame, low: np.ndarray, counts: np.ndarray) -> Iterator[pd.DataFrame]:
        """``counts`` reports of every state, their numbers from ``low`` on; ``_ROWS`` at a time, whatever a state's count."""
        before = np.cumsum(counts) - counts
        for start in range(0, int(counts.sum()), _ROWS):
            n = np.arange(start, min(start + _ROWS, int(counts.sum())))
            of = np.searchsorted(before + counts, n, side="right")
            yield from self._frames(known.iloc[of], low[of] + n - before[of], "periodic")

    def _frames(self, states: pd.DataFrame, numbers, kind: str) -> Iterator[pd.DataFrame]:
        if len(states):
            frame = states[["mission_id", *STATE]].astype(dict.fromkeys(_NUMBERS, float))
            frame.insert(1, "report_no", numbers)
            frame.insert(2, "kind", kind)
            yield frame.reset_index(drop=True)

    def close(self) -> None:
        pass


def due_reports(
    telemetry: DataFrame,
    missions: DataFrame,
    period_seconds: Column | None = None,
    anchor: Column | None = None,
    lateness: str = "0 seconds",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming reports as ``reports.report_snapshots`` gives them, each sent once the watermark has passed its time.

    ``telemetry`` carries its place of arrival. The watermark is the latest event time of any mission less ``lateness``;
    it is the clock by which silent missions report. A tick older than that is dropped, as its reports are out. A period
    that is null or not positive has no periodic reports.
    """
    period = F.col("report_freq_min") * 60 if period_seconds is None else period_seconds
    begin = F.col("started_at") if anchor is None else anchor
    plan = missions.select(
        "mission_id",
        F.when((period > 0) & begin.isNotNull(), period.cast("bigint") * 1000).otherwise(0).alias("period"),
        F.coalesce(F.unix_millis(begin.cast("timestamp")), F.lit(0)).alias("begin"),
    )
    ticks = telemetry.withColumns(
        {
            "mission_id": F.col("mission_id").try_cast("bigint"),
            "event_time": F.to_timestamp(utc_text_to_ntz(F.col("timestamp")).cast("string")),
            "terminal": is_terminal(),
            "status": F.when(F.col("status") == C.REPAIR, F.lit(C.REPAIR)).otherwise(C.OK),
        }
    ).where(F.col("event_time").isNotNull())
    ticks = ticks.withWatermark("event_time", lateness).join(plan, "mission_id")
    bucket = F.pmod(F.xxhash64("mission_id"), F.lit(buckets)).cast("int").alias("bucket")
    ticks = ticks.select(bucket, "mission_id", "event_time", F.unix_millis("event_time").alias("at"), "period", "begin", "terminal",
                         "mission_status", *STATE, *PLACE)
    schema = struct(mission_id=LONG, report_no=LONG, kind=TEXT, **{f.name: f.dataType for f in _STATE_TYPE.fields})
    made = _processed(ticks, "bucket", DueReports(), schema, "EventTime")
    return score_health(made)
