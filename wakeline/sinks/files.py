"""Report, log and document files.

The object-store habit of one small object per mission and day does not survive a large fleet: millions of directories
are slow to list and to commit. Reports, manifests and audit events are therefore written as rows partitioned by day,
with their object key as a column; ``layout="files"`` keeps one directory per key for small volumes and for readers
that expect it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from wakeline.functions.text import file_stem, report_key
from wakeline.operators.aggregates import count_into
from wakeline.operators.skew import spread_for_write
from wakeline.session import freeing_shuffles


def write_raw_logs(logs: DataFrame, path: str, run_id: int = 0) -> None:
    """Raw mission logs as CSV with header, in a folder of the run; a repeated run replaces its own."""
    logs.write.mode("overwrite").option("header", "true").csv(f"{path}/run_id={run_id}")


def export_reports(
    reports: DataFrame, path: str, run_id: int = 0, layout: str = "rows", counter: Observation | None = None
) -> None:
    """Cleaned report rows as Parquet; an object (mission and day) exported again is replaced by the later run's.

    ``rows``: a directory per reporting day and run, ``object_key`` as a column, sorted by it; a repeated run replaces
    its own rows, and ``read_report_rows`` leaves choosing an object's newest run to the ingest. ``files``: a directory
    per mission and day, replaced as a whole. ``runs``: a directory per run, read like ``rows``, for runs that touch many
    days with few rows each. Either way the report columns stay in the files and a large day or
    object is written by several tasks.
    """
    day = F.substring("timestamp", 1, 10)
    key = report_key(F.col("mission_id"), day.cast("date"))
    rows = reports.withColumns({"report_date": day, "object_key": key})
    content = F.struct("mission_id", "item", "timestamp", "value")
    if layout == "rows":
        rows = rows.withColumn("run_id", F.lit(run_id).cast("bigint"))
        spread, levels = spread_for_write(rows, "report_date", content), ["report_date", "run_id"]
    elif layout == "files":
        rows = rows.withColumn("report_mission", F.col("mission_id"))
        spread, levels = spread_for_write(rows, "object_key", content), ["report_mission", "report_date"]
    elif layout == "runs":
        rows = reports.repartitionByRange(key, content)  # names and days are made where the rows have arrived
        rows = rows.withColumns({"report_date": day.cast("date"), "object_key": key, "run_id": F.lit(run_id).cast("bigint")})
        spread, levels = rows, ["run_id"]
    else:
        raise ValueError(f"unknown report layout: {layout}")
    out = count_into(spread.sortWithinPartitions(*levels, "object_key"), counter)
    out = out.drop("object_key") if layout == "files" else out
    with freeing_shuffles(reports.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*levels).parquet(path)


def write_manifest_documents(documents: DataFrame, path: str, run_id: int = 0, layout: str = "rows") -> None:
    """Manifest documents ``manifest_path, text``; a later run's document of a path replaces the earlier.

    ``rows``: Parquet rows below ``run_id``, read back with ``read_manifest_rows``. ``files``: one JSON text file per
    path, in a directory of its own.
    """
    if layout == "rows":
        with freeing_shuffles(documents.sparkSession):
            documents.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/run_id={run_id}")
        return
    if layout != "files":
        raise ValueError(f"unknown manifest layout: {layout}")
    stem = file_stem(F.element_at(F.split("manifest_path", "/"), -1))
    day = F.element_at(F.split("manifest_path", "/"), 2)
    rows = documents.select(F.col("text").alias("value"), day.alias("manifest_date"), stem.alias("manifest"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("manifest_date", "manifest").text(path)


def write_audit_log(events: DataFrame, path: str, by_mission: bool = False, run_id: int = 0) -> None:
    """Audit events as JSON below ``log_date`` (and, for small volumes, the mission) and the run, which replaces its own.

    The many events of a day are compressed; a mission's few stay plain text.
    """
    levels = ["log_date"]
    if by_mission:
        events = events.withColumn("log_mission", F.col("mission_id")).drop("object_key")
        levels.append("log_mission")
    rows = events.withColumn("run_id", F.lit(run_id).cast("bigint"))
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*levels, "run_id")
    out.json(path, compression="none" if by_mission else "gzip")


def write_sorted(df: DataFrame, path: str, *order) -> None:
    """A mart stored in rank order, so row-group statistics serve top-of-list reads."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)
