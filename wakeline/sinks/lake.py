"""The telemetry lake: Parquet, partitioned by mission.

Missions number in the tens of millions on a large fleet, and a directory for each (times one per micro-batch) is more
than a file system or a driver can list. The lake therefore groups missions into a fixed number of buckets by a hash of
their id, sorts each file by mission so that row-group statistics single out one mission, and leaves the
directory-per-mission layout as an option for small fleets. Rows and columns read back are the same either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from wakeline.operators.aggregates import count_into
from wakeline.operators.skew import ROWS_PER_SLICE, spread_for_write

BUCKETS = 64


def mission_bucket(mission_id: Column, buckets: int = BUCKETS) -> Column:
    """Directory bucket of a mission; rows without a mission share bucket 0."""
    return F.coalesce(F.pmod(F.xxhash64(mission_id), F.lit(buckets)), F.lit(0)).cast("int")


def write_lake(
    parsed: DataFrame,
    batch_id: int,
    path: str,
    layout: str = "bucket",
    buckets: int = BUCKETS,
    rows_per_file: int = ROWS_PER_SLICE,
    counter: Observation | None = None,
) -> None:
    """Add one micro-batch to the lake.

    The batch id is the inner partition level and only partitions of the batch are replaced: a retried batch rewrites
    its own directories instead of appending twice. A mission above ``rows_per_file`` rows is written as several files
    by several tasks.
    """
    rows = parsed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    if layout == "bucket":
        rows = rows.withColumn("mission_bucket", mission_bucket(F.col("mission_id"), buckets))
        level = "mission_bucket"
    elif layout == "mission":
        level = "mission_id"
    else:
        raise ValueError(f"unknown lake layout: {layout}")
    spread = spread_for_write(rows, level, F.col("seq"), rows_per_file).sortWithinPartitions(level, "mission_id", "seq")
    count_into(spread, counter).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        level, "batch_id"
    ).parquet(path)


def publish_topic(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send ``key, value`` records to a topic (needs the Kafka connector on the classpath)."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**options).save()
