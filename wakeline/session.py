"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is designed around. A cluster keeps its own shuffle partition count and memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # a quarter of plan construction time
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "wakeline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` takes further options with ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only where the cluster names none (a bare local session, as in tests) is a local folder made and set.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wakeline-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/wakeline/{name}-{uuid.uuid4().hex}"


#: Whether the files that a query shuffled go when it ends; Spark keeps them until the driver collects its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """For writes: what they shuffled goes as soon as each is done. A plan written again shuffles again, as it does anyway."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows, written once below the shared folder and read back: cuts lineage, and later uses don't compute them again."""
    return _stored(df, work_path(df.sparkSession, name), compression)


@contextmanager
def stored_meanwhile(df: DataFrame, name: str, compression: str = "snappy") -> Iterator[DataFrame]:
    """``stored`` rows that are deleted at the end."""
    path = work_path(df.sparkSession, name)
    try:
        yield _stored(df, path, compression)
    finally:
        jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


def _stored(df: DataFrame, path: str, compression: str) -> DataFrame:
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
