"""Report files, raw logs, manifest documents and file hashes, each read as one distributed scan."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wakeline.operators.arrival import latest_per_key
from wakeline.schemas import DATE, LONG, MANIFEST_DOCUMENT, RAW_REPORT, TEXT, struct
from wakeline.session import stored

#: Bytes of a file read at once.
PIECE = 1 << 20


def _object_key(root: str) -> Column:
    """Path of the scanned file below ``root``."""
    bare = root.rstrip("/").split("://")[-1].removeprefix("file:")
    path = F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), r"^[a-z0-9]+:/+(?=[^/])", "/")
    return F.regexp_replace(path, f"^/*{_quoted(bare.lstrip('/'))}/+", "")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def _recursive(spark: SparkSession, glob: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)


def manifest_texts(files: DataFrame, root: str) -> DataFrame:
    """``manifest_path, text`` of a (batch or streaming) whole-text scan below ``root``."""
    return files.select(_object_key(root).alias("manifest_path"), F.col("value").alias("text"))


def read_manifest_texts(spark: SparkSession, root: str) -> DataFrame:
    """``manifest_path, text`` for every ``.json`` file below ``root``, whole documents."""
    return manifest_texts(_recursive(spark, "*.json").text(root, wholetext=True), root)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Typed manifest documents (multi-line JSON) with their ``manifest_path``; optional fields are null."""
    reader = _recursive(spark, "*.json").schema(MANIFEST_DOCUMENT).option("multiLine", "true")
    return reader.json(root).select(_object_key(root).alias("manifest_path"), *MANIFEST_DOCUMENT.names)


def read_manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """``manifest_path, text`` of documents stored as rows; of a path's documents the one of the newest run.

    Nothing replaces a document of the last run, so its texts stay where they are; only paths are dealt out to find those
    it holds twice, and earlier documents that it replaced. Texts of earlier runs and of such paths meet by path.
    """
    rows = spark.read.schema(struct(manifest_path=TEXT, text=TEXT, run_id=LONG)).parquet(path)
    last_run = F.lit(rows.agg(F.max("run_id")).first()[0]).cast("bigint")
    last, earlier = rows.where(F.col("run_id") == last_run), rows.where(F.col("run_id") < last_run)
    held = last.groupBy(F.col("manifest_path").alias("_held")).agg(F.count(F.lit(1)).alias("_n"))
    twice = stored(held.where("_n > 1").select("_held"), "twice")
    same = F.col("manifest_path").eqNullSafe(F.col("_held"))
    once = last.join(twice, same, "left_anti")
    rest = last.join(twice, same, "left_semi").unionAll(earlier.join(last.select(F.col("manifest_path").alias("_held")), same, "left_anti"))
    return once.unionAll(latest_per_key(rest, ["manifest_path"], "run_id").select(*once.columns)).select("manifest_path", "text")


def stream_manifest_rows(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    """Streaming ``manifest_path, text`` of documents stored as rows; a trigger takes ``max_files`` files at most."""
    reader = spark.readStream.schema(struct(manifest_path=TEXT, text=TEXT, run_id=LONG))
    return reader.option("maxFilesPerTrigger", max_files).parquet(path).select("manifest_path", "text")


def read_reports(spark: SparkSession, root: str, modified_after: str | None = None) -> DataFrame:
    """All report rows of a one-file-per-key store with the ``object_key`` of their file. Timestamps stay text.

    ``modified_after`` (an ISO time) leaves older files out of the listing; an incremental run passes its last time.
    """
    reader = _recursive(spark, "*.parquet").schema(RAW_REPORT)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.parquet(root).select(*RAW_REPORT.names, _object_key(root).alias("object_key"))


def read_report_rows(spark: SparkSession, path: str) -> DataFrame:
    """Report rows stored by day and run, with ``object_key`` and the partition columns ``report_date, run_id``."""
    extra = struct(object_key=TEXT, report_date=DATE, run_id=LONG)
    return spark.read.schema(T.StructType(RAW_REPORT.fields + extra.fields)).parquet(path)


def read_mission_logs(spark: SparkSession, path: str) -> DataFrame:
    """Raw mission logs (CSV with header), columns taken by name; nothing is inferred.

    All columns are read as text, so a log lacking a required column is noticed by ``clean_reports``.
    """
    return spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(path)


def newest_run(rows: DataFrame, key: str = "object_key") -> DataFrame:
    """Of report rows stored by run, those of each object's newest run; rows without a key are left out.

    Nothing replaces an object that only the first run has, so objects are listed of later runs only. ``key`` may be any
    column that names the object; what is grouped by it afterwards is not dealt out again.
    """
    first = F.lit(rows.agg(F.min("run_id")).first()[0]).cast("bigint")
    later = rows.where(F.col("run_id") > first).groupBy(F.col(key).alias("_key")).agg(F.max("run_id").alias("_newest"))
    return rows.where(F.col(key).isNotNull()).join(later, (F.col(key) == F.col("_key")) & (F.col("run_id") < F.col("_newest")), "left_anti")


def file_hashes(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``object_key, length, sha256`` of every file below ``root``.

    Files are listed without their content; a task reads its files from the store in pieces of ``PIECE`` bytes, so a
    file of any size takes one piece of memory. Files without a byte are not listed.
    """
    files = _recursive(spark, glob).format("binaryFile").load(root)
    listed = files.select(_object_key(root).alias("object_key"), "path", "length")
    hashed = listed.mapInArrow(_hash_files, struct(object_key=TEXT, path=TEXT, length=LONG, sha256=TEXT))
    return hashed.drop("path")


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            store, name = (pa.fs.LocalFileSystem(), path[5:]) if path.startswith("file:") else pa.fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with store.open_input_stream(name) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=["object_key", "path", "length", "sha256"])
