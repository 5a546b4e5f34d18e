"""Telemetry stream, its decoding, and the lake it lands in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wakeline.schemas import INT, LONG, TELEMETRY, TEXT, struct
from wakeline.sinks.lake import BUCKETS, mission_bucket

TOPIC = "telemetry.raw"

#: Columns of a topic record; a file source holds the same records as Parquet.
TOPIC_RECORD = struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=TEXT, partition=INT, offset=LONG, timestamp=T.TimestampType()
)


def telemetry_source(
    spark: SparkSession,
    kind: str,
    *,
    servers: str | None = None,
    topic: str = TOPIC,
    path: str | None = None,
    starting: str | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Streaming topic records. ``kind`` is ``kafka`` (needs the Kafka connector on the classpath) or ``files``.

    ``starting="latest"`` (the default) tails the topic, ``"earliest"`` replays it; either way a restarted query
    continues from its own checkpoint, which takes the place of a consumer group. Files are always read from the first
    one, in tasks of the file reader's choice: the options that say otherwise are refused there.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting or "latest")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_partitions:
            reader = reader.option("minPartitions", min_partitions)
        return reader.load()
    if kind == "files":
        if starting not in (None, "earliest") or min_partitions:
            raise ValueError("a file source takes neither starting='latest' nor min_partitions")
        reader = spark.readStream.schema(TOPIC_RECORD)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.parquet(path)
    raise ValueError(f"unknown telemetry source kind: {kind}")


def parse_telemetry(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed telemetry from JSON ``value``s, plus the record columns in ``keep``.

    Permissive: a malformed value gives an all-null row, an unknown field is dropped, a mistyped one is null.
    The document is unfolded as a list of one: later filters on its fields then don't parse the text once more each.
    """
    decoded = F.from_json(F.col("value").cast("string"), TELEMETRY)
    return records.select(*keep, F.inline(F.array(decoded)))


def malformed(parsed: DataFrame) -> DataFrame:
    """Rows without a mission: not JSON, or an event no table can take."""
    return parsed.where(F.col("mission_id").isNull())


def unreadable(records: DataFrame) -> DataFrame:
    """Records whose value is no JSON object, or one without mission and ship: no row can be made of them."""
    decoded = F.from_json(F.col("value").cast("string"), TELEMETRY)
    return records.where(F.coalesce(decoded["mission_id"], decoded["ship_id"]).isNull())


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The telemetry lake in either layout. The schema is declared, so ``mission_id`` stays text ("007" is not 7)."""
    extra = [T.StructField("seq", LONG), T.StructField("batch_id", LONG), T.StructField("mission_bucket", INT)]
    return spark.read.schema(T.StructType(TELEMETRY.fields + extra)).parquet(path)


def read_mission(spark: SparkSession, path: str, mission_id: str, buckets: int = BUCKETS) -> DataFrame:
    """One mission's rows of a bucketed lake: prunes to its directory, then to its row groups."""
    wanted = F.lit(mission_id)
    return read_lake(spark, path).where(
        (F.col("mission_bucket") == mission_bucket(wanted, buckets)) & (F.col("mission_id") == wanted)
    )
