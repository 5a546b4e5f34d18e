"""Streaming queries over topic records (``key, value, partition, offset``).

Every query keeps its position in its own checkpoint. Micro-batch handlers write under the batch id, so a batch that
is retried after a lost executor or driver replaces its own output.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.operators.reshape import METRIC_KEYS, latest_gauges
from wakeline.plans.ingest import ingest_manifests, parse_manifests
from wakeline.plans.radar import drop_finished, named_ships
from wakeline.schemas import DOUBLE, TEXT, struct
from wakeline.session import stored_meanwhile
from wakeline.sinks.days import DayLake
from wakeline.sinks.landing import append_landing, read_registered, read_waiting, write_waiting
from wakeline.sinks.lake import write_lake
from wakeline.sources.files import manifest_texts
from wakeline.sources.tables import BucketTable, TableStore
from wakeline.sources.telemetry import parse_telemetry, unreadable
from wakeline.streaming.states import PLACE, arrival_number, due_reports, start_stateful, status_changes

log = logging.getLogger(__name__)

EVERY_SECOND = {"processingTime": "1 second"}
DRAIN = {"availableNow": True}

METRICS = struct(metric=TEXT, help=TEXT, ship_id=TEXT, mission_id=TEXT, value=DOUBLE)


def metrics_table(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """Latest sample per metric, ship and mission; the samples of a ship's mission share a bucket."""
    return BucketTable(spark, path, tuple(METRIC_KEYS), METRICS, ("ship_id", "mission_id"), buckets)


def arriving(records: DataFrame) -> DataFrame:
    """Parsed telemetry with its offset as ``seq``."""
    return parse_telemetry(records.withColumn("seq", F.col("offset")), keep=("seq",))


def placed(records: DataFrame) -> DataFrame:
    """Parsed telemetry with its place of arrival: record time, partition, offset.

    A ship's records need not share a partition (records without key are dealt out, partitions are added), so offsets
    alone do not order them.
    """
    at = F.coalesce(F.unix_millis("timestamp"), F.lit(0)) if "timestamp" in records.columns else F.lit(0)
    return parse_telemetry(records.withColumn("arrived", at.cast("bigint")), keep=PLACE)


def run_telemetry(
    source: DataFrame, checkpoint: str, lake: str | DayLake, trigger: dict = EVERY_SECOND, rejects_path: str | None = None
) -> StreamingQuery:
    """Land the stream in the lake: one by day, or one by mission bucket below a path.

    With ``rejects_path`` records that give no row (no JSON, neither mission nor ship) go there instead, as they came.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = arriving(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if parsed.isEmpty():
                return
            if rejects_path is not None:
                unreadable(batch).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
            landed = parsed if rejects_path is None else parsed.where(F.coalesce("mission_id", "ship_id").isNotNull())
            counter = Observation()
            if isinstance(lake, DayLake):
                lake.write(landed, batch_id, counter=counter)
            else:
                write_lake(landed, batch_id, lake, counter=counter)
            log.info("batch %d: %d telemetry rows", batch_id, counter.get["rows"])
        finally:
            parsed.unpersist()

    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_metrics(source: DataFrame, table: BucketTable, checkpoint: str, trigger: dict = EVERY_SECOND) -> StreamingQuery:
    """Keep the latest gauges in ``table``: the newest complete row per ship and mission is Spark's state, and only keys
    that a micro-batch changes leave it, into the buckets they fall in."""

    def publish(changed: DataFrame, batch_id: int) -> None:
        table.put(changed, batch_id)

    latest = latest_gauges(placed(source), arrival_number())
    return (
        latest.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_lake(source: DataFrame, lake: str | DayLake, checkpoint: str, trigger: dict = EVERY_SECOND) -> StreamingQuery:
    """Land the stream in the lake only."""
    return run_telemetry(source, checkpoint, lake, trigger)


def radar_stream(source: DataFrame) -> DataFrame:
    """Streaming latest event per ship; the state store holds one event per ship."""
    events = named_ships(placed(source)).withColumn("seq", F.col("offset"))
    rest = [c for c in events.columns if c not in ("ship_id", *PLACE)]
    latest = events.groupBy("ship_id").agg(F.max_by(F.struct(*rest), arrival_number()).alias("_row"))
    return drop_finished(latest.select("ship_id", "_row.*"))


def run_radar(source: DataFrame, store: TableStore, checkpoint: str, trigger: dict = EVERY_SECOND) -> StreamingQuery:
    """Publish the whole current fleet picture at every trigger as table ``radar_latest``."""

    def publish(snapshot: DataFrame, batch_id: int) -> None:
        store.write(snapshot, "radar_latest", batch_id)
        store.prune("radar_latest")

    return (
        radar_stream(source)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_transitions(source: DataFrame, log_path: str, checkpoint: str, trigger: dict = EVERY_SECOND) -> StreamingQuery:
    """Append status changes to ``log_path``, by batch; the status each ship is known by is Spark's state."""

    def handle(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    changes = status_changes(placed(source))
    writer = changes.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return start_stateful(writer.trigger(**trigger), source.sparkSession)


def run_reports(
    source: DataFrame,
    missions: DataFrame,
    reports_path: str,
    checkpoint: str,
    trigger: dict = EVERY_SECOND,
    period_seconds: Column | None = None,
    anchor: Column | None = None,
    lateness: str = "0 seconds",
) -> StreamingQuery:
    """Append the captains' reports that fall due to ``reports_path``, by batch (see ``states.due_reports``)."""

    def handle(reports: DataFrame, batch_id: int) -> None:
        reports.write.mode("overwrite").parquet(f"{reports_path}/batch_id={batch_id}")

    reports = due_reports(placed(source), missions, period_seconds, anchor, lateness)
    writer = reports.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return start_stateful(writer.trigger(**trigger), source.sparkSession)


def new_manifest_files(spark: SparkSession, root: str, max_files: int = 10_000, archive: str | None = None) -> DataFrame:
    """Streaming ``manifest_path, text`` of manifest files not seen by the query before, ``max_files`` a trigger at most.

    With ``archive``, a folder outside ``root``, files are moved there (keeping their path) once their batch is done and
    another one begins, so that the next listing finds only what is new.
    """
    reader = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return manifest_texts(reader.load(root), root)


def run_ingest(
    manifests: DataFrame,
    report_rows: Callable[[], DataFrame],
    landing_root: str,
    checkpoint: str,
    as_of: Callable[[], datetime | str],
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Ingest newly arrived manifests into the landing tables, one run per micro-batch.

    ``report_rows`` and ``as_of`` are called once per batch, for a fresh file listing and the ingest time. With the
    default trigger the query takes what is new since its last run and ends, so a scheduler can start it every few
    minutes. Manifests whose report is missing are kept in ``waiting`` and taken up again by every later batch; what
    cannot be read or does not fit is listed in ``rejected``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        texts = batch.unionByName(read_waiting(spark, landing_root, batch_id))
        if texts.isEmpty():
            return
        # Stored, not cached: a file's documents are one cached block, which a task far from it fetches whole.
        with stored_meanwhile(parse_manifests(texts), "manifests", "zstd") as documents:
            earlier = read_registered(spark, landing_root, documents, batch_id)
            landing = ingest_manifests(documents, report_rows(), earlier, as_of())
            write_waiting(texts, landing.waiting, landing_root, batch_id)
            append_landing(landing, landing_root, batch_id)

    return manifests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
