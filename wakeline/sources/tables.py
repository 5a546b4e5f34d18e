"""Layer tables as versioned Parquet directories: ``root/layer/table/version=N``.

A rebuild writes a new version and becomes current once its write has committed, so a plan never overwrites what it
reads and a run lost halfway leaves the previous version in place. A version number may be written again (a retried
micro-batch, a rerun): it replaces only itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wakeline.operators.upsert import upsert


@dataclass(frozen=True)
class TableStore:
    """Versioned tables below ``root``, a folder all executors share."""

    spark: SparkSession
    root: str

    def versions(self, table: str) -> list[int]:
        """Committed versions, oldest first."""
        fs, base = self._fs(self._table(table))
        if not fs.exists(base):
            return []
        jvm = self.spark._jvm
        found = []
        for status in fs.listStatus(base):
            name = status.getPath().getName()
            if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(int(name.removeprefix("version=")))
        return sorted(found)

    def read(self, table: str, schema: T.StructType | None = None, below: int | None = None) -> DataFrame:
        """Current version, or the newest one before version ``below``; empty with ``schema`` where there is none."""
        found = [v for v in self.versions(table) if below is None or v < below]
        if not found:
            if schema is None:
                raise FileNotFoundError(f"no version of {table} below {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self._version(table, found[-1]))

    def write(self, df: DataFrame, table: str, version: int | None = None) -> DataFrame:
        """Write the next (or the given) version and return it as read back."""
        if version is None:
            version = (self.versions(table) or [0])[-1] + 1
        path = self._version(table, version)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def prune(self, table: str, keep: int = 10) -> None:
        """Delete all but the newest ``keep`` versions of a table that is rewritten often."""
        for version in self.versions(table)[:-keep]:
            fs, path = self._fs(self._version(table, version))
            fs.delete(path, True)

    def _table(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def _version(self, table: str, version: int) -> str:
        return f"{self._table(table)}/version={version}"

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath


@dataclass(frozen=True)
class BucketTable:
    """A keyed table below ``path`` as ``bucket=B/version=V``: an update rewrites the buckets that its keys fall in.

    Other buckets stay as they are, file for file. ``by`` are the keys that decide the bucket. A bucket's newest version
    counts; ``keep`` of them stay. A version written again (a retried micro-batch or run) starts from what was there before
    it. Changed rows are written below ``_changes`` first, so that they are computed once and survive a lost executor.
    A large bucket is written by several tasks, small ones share a task.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    by: tuple[str, ...] = ()
    buckets: int = 64
    keep: int = 2

    def current(self, below: int | None = None) -> dict[int, int]:
        """Newest version of every bucket, or the newest before ``below``: one listing of at most buckets x keep folders."""
        newest: dict[int, int] = {}
        for bucket, version in self._versions():
            if below is None or version < below:
                newest[bucket] = max(version, newest.get(bucket, version))
        return newest

    def read(self, below: int | None = None, only: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets, as of the newest version or of the newest one before ``below``."""
        found = {b: v for b, v in self.current(below).items() if only is None or b in only}
        if not found:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/bucket={b}/version={v}" for b, v in sorted(found.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def put(self, rows: DataFrame, version: int, update_cols: list[str] | str = "all") -> list[int]:
        """Insert or update ``rows`` (one per key) as ``version``; returns the buckets that were rewritten."""
        columns = [f.name for f in self.schema.fields]
        self._delete([f"bucket={b}/version={v}" for b, v in self._versions() if v == version])  # of a lost attempt
        staged = f"{self.path}/_changes/version={version}"
        changed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        changed.withColumn("bucket", self._bucket()).write.mode("overwrite").partitionBy("bucket").parquet(staged)
        touched = sorted(int(p.getName().split("=")[1]) for p in self._glob(f"{staged}/bucket=*"))
        if touched:
            batch = self.spark.read.schema(self.schema).parquet(*[f"{staged}/bucket={b}" for b in touched])
            merged = upsert(self.read(version, touched), batch, list(self.keys), update_cols, null_keys=True)
            placed = merged.select(*columns, self._bucket().alias("bucket"), F.lit(version).cast("bigint").alias("version"))
            placed.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "bucket", "version"
            ).parquet(self.path)
        self._prune(version)
        return touched

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(self.by or self.keys)), F.lit(self.buckets)).cast("int")

    def _versions(self) -> list[tuple[int, int]]:
        found = self._glob(f"{self.path}/bucket=*/version=*")
        return [(int(p.getParent().getName().split("=")[1]), int(p.getName().split("=")[1])) for p in found]

    def _prune(self, version: int) -> None:
        held: dict[int, list[int]] = {}
        for bucket, v in self._versions():
            held.setdefault(bucket, []).append(v)
        old = [f"bucket={b}/version={v}" for b, vs in held.items() for v in sorted(vs)[: -self.keep]]
        stale = [p.getName() for p in self._glob(f"{self.path}/_changes/version=*")]
        old += [f"_changes/{name}" for name in stale if int(name.split("=")[1]) <= version - self.keep]
        self._delete(old)

    def _delete(self, names: list[str]) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _glob(self, pattern: str) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        return [s.getPath() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def read_table(spark: SparkSession, name: str, kind: str = "catalog", **options: str) -> DataFrame:
    """A warehouse table: ``catalog`` (a registered table), ``parquet`` (a path) or ``jdbc`` (connector options)."""
    if kind == "catalog":
        return spark.table(name)
    if kind == "parquet":
        return spark.read.parquet(name)
    if kind == "jdbc":
        return spark.read.format("jdbc").option("dbtable", name).options(**options).load()
    raise ValueError(f"unknown table kind: {kind}")
