"""Landing layer: telemetry rows, report rows and manifest documents become typed tables."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wakeline import catalogue as C
from wakeline.functions.text import pack_hex, sha256_hex, unpack_hex
from wakeline.functions.times import instant, utc_text_to_ntz
from wakeline.operators.aggregates import distinct_rows
from wakeline.operators.keys import require_columns, unseen
from wakeline.operators.skew import sliced_join
from wakeline.schemas import MANIFEST_DOCUMENT, MANIFESTS, MISSION_REPORTS, REPORT_COLUMNS, SHIP_STATE, land
from wakeline.session import stored


class Landing(NamedTuple):
    """What one ingest run appends. Write ``manifests`` last: it marks the others as complete.

    ``waiting`` names new manifests whose report is not there; they stay new and nothing of them is appended.
    ``rejected`` (source, reason, detail) lists what could not be taken: documents without a readable mission or date,
    report rows that do not fit the landing table (they are left out of it), and readings of a state that do not fit
    (the state lands without them).
    """

    reports: DataFrame
    ship_state: DataFrame
    manifests: DataFrame
    waiting: DataFrame
    rejected: DataFrame


def telemetry_to_ship_state(scored: DataFrame) -> DataFrame:
    """Scored telemetry as ship-state ticks at event time, with the defaults of an ingested state."""

    def first_of(*names: str, default=None) -> Column:
        found = [F.col(n) for n in names if n in scored.columns]
        return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)

    ticks = scored.withColumns(
        {
            "mission_id": F.col("mission_id").try_cast("bigint"),
            "timestamp": utc_text_to_ntz(F.col("timestamp")),
            "fuel_prc": first_of("fuel_prc", default=0.0),
            "temperature_C": first_of("temperature_C", "motor_temp_c", default=0.0),
            "radiation_uSv": first_of("radiation_uSv", default=0.0),
            "cargo_integrity_prc": first_of("cargo_integrity_prc", default=100.0),
            "planet": first_of("planet", default=C.UNKNOWN),
        }
    )
    return land(ticks, SHIP_STATE)


def clean_reports(raw: DataFrame) -> DataFrame:
    """Checked report rows: whole-row duplicates removed, value numeric, timestamp kept as text."""
    require_columns(raw, REPORT_COLUMNS)
    return distinct_rows(raw).withColumns(
        {"value": F.col("value").cast("double"), "timestamp": F.col("timestamp").cast("string")}
    )


def parse_manifests(texts: DataFrame) -> DataFrame:
    """Manifest documents from ``manifest_path, text``; a document that is no JSON object gives nulls.

    The document is unfolded as a list of one: later filters on its fields then don't parse the text once more each.
    """
    doc = F.from_json("text", MANIFEST_DOCUMENT)
    checksum = sha256_hex(F.col("text").cast("binary")).alias("checksum_manifest")
    return texts.select("manifest_path", checksum, F.inline(F.array(doc)))


def _keyed(documents: DataFrame) -> DataFrame:
    mission, day = F.col("mission_id").try_cast("bigint"), F.col("date").try_cast("date")
    return documents.withColumns({"mission_id": mission, "mission_date": day})


def unreadable_manifests(documents: DataFrame) -> DataFrame:
    """``source, reason, detail`` of documents that are no JSON object or lack a readable mission or date."""
    bad = _keyed(documents).where(F.col("mission_id").isNull() | F.col("mission_date").isNull())
    return bad.select(
        F.col("manifest_path").alias("source"),
        F.lit("no readable mission or date").alias("reason"),
        F.col("checksum_manifest").alias("detail"),
    )


def new_manifests(documents: DataFrame, registered: DataFrame) -> DataFrame:
    """Documents of (mission, date) pairs not registered yet; of repeats the first path is taken."""
    once = _new_packed(documents, registered)
    back = {c: unpack_hex(F.col(c)) for c in _SUMS if c in once.columns}
    if "checksum" in back:
        back["checksum"] = F.struct(back["checksum"].alias("mission"))
    return once.withColumns(back)


#: Checksums of a document as they are named there.
_SUMS = {"checksum_manifest": "checksum_manifest", "checksum": "checksum.mission"}


def _new_packed(documents: DataFrame, registered: DataFrame) -> DataFrame:
    """The new documents with their checksums as bytes (``pack_hex``).

    Documents without a readable key (``unreadable_manifests``) leave first, so they do not meet as one group. The
    documents are dealt out once, without the columns that the caller leaves unused.
    """
    keys = ["mission_id", "mission_date"]
    readable = _keyed(documents).where(F.col("mission_id").isNotNull() & F.col("mission_date").isNotNull())
    rest = [c for c in readable.columns if c not in keys]
    typed = unseen(readable.withColumns({c: pack_hex(F.col(text)) for c, text in _SUMS.items() if c in rest}), registered, keys)
    by_path = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("manifest_path"))
    return typed.withColumn("_place", F.row_number().over(by_path)).where("_place = 1").select(*keys, *rest)


def _misfits(df: DataFrame, schema: T.StructType) -> Column:
    """``name=value`` of the columns whose value is there but not representable in the landing table, else null."""
    have = dict(df.dtypes)
    bad = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name}="), F.col(f.name).cast("string")))
        for f in schema.fields
        if f.name in have and have[f.name] != f.dataType.simpleString()
    ]
    return F.nullif(F.concat_ws(", ", *bad), F.lit("")) if bad else F.lit(None).cast("string")


def ingest_manifests(
    documents: DataFrame, report_rows: DataFrame, registered: DataFrame, as_of: datetime | str, keep: bool = True, keep_lineage: bool = False
) -> Landing:
    """Rows to append to the three landing tables for all new manifests, in one set-based run.

    ``documents``: parsed manifests with ``manifest_path, checksum_manifest``; persist them when they come from text.
    ``report_rows``: report rows with the ``object_key`` of their file and, where stored by day and run, ``report_date``
    and ``run_id``: the newest run of an object counts. The report rows are the large side and never pass a group; a
    file that holds a large share of them is sliced for the join.

    With ``keep``, stored first is one row for every new manifest and every object, with the object's newest run and row
    count (one scan of two columns of the report rows); checksums travel and are stored as bytes. Completeness, waiting, states, registrations and hot objects come
    from this table, so the report rows are read once more for the rows that land, and once for those that do not fit.
    Without it nothing is stored and each part carries only its own columns: for callers that use one part. Of these,
    ``keep_lineage`` is for those that use the report rows: it stores the new manifests' objects and checksums, so that
    what was shuffled to find them is gone before the report rows are dealt out.
    """
    new = _new_packed(documents, registered).select(
        *("mission_id", "mission_date", "manifest_path", "checksum_manifest", "checksum", "upload_time", "ship_state"),
        F.col("files.mission").alias("object_key"),
    )
    if "report_date" in report_rows.columns:
        # One row per calendar day at most, so the broadcast is bounded; it prunes the day partitions of the scan.
        days = new.select(F.col("mission_date").alias("report_date")).distinct()
        report_rows = report_rows.join(F.broadcast(days), "report_date", "left_semi")
    by_run = "run_id" in report_rows.columns
    run = F.col("run_id") if by_run else F.lit(0).cast("bigint")
    report_rows = report_rows.select(*REPORT_COLUMNS, "object_key", run.alias("run_id"))
    objects = report_rows.where(F.col("object_key").isNotNull()).groupBy("object_key")
    objects = objects.agg(F.max("run_id").alias("newest_run"), F.count(F.lit(1)).alias("n"))
    if keep:
        settled = stored(new.join(objects, "object_key", "full"), "settled", "zstd")
        counts = settled.where(F.col("n").isNotNull()).select("object_key", "n").distinct()
    else:
        settled, counts = new.join(objects, "object_key", "left"), objects.select("object_key", "n")
    complete = settled.where(F.col("mission_id").isNotNull() & F.col("newest_run").isNotNull())

    # Where objects have one run, the join with their rows leaves out the manifests without any.
    landing = complete if keep or by_run else new.withColumn("newest_run", F.lit(0).cast("bigint"))
    lineage = landing.select("object_key", "newest_run", F.col("checksum").alias("_checksum"))
    if keep_lineage and not keep:
        lineage = stored(lineage, "lineage", "zstd")
    judged = report_rows.withColumn("_misfit", _misfits(report_rows.select(*REPORT_COLUMNS), MISSION_REPORTS))

    def of_new(rows: DataFrame) -> DataFrame:
        joined = sliced_join(rows, lineage, "object_key", F.struct(*REPORT_COLUMNS), counts=counts)
        landed = joined.where(F.col("run_id") == F.col("newest_run"))
        return landed.withColumns({"source_file": F.col("object_key"), "file_checksum": unpack_hex(F.col("_checksum"))})

    reports = of_new(judged.where(F.col("_misfit").isNull())).select(
        *REPORT_COLUMNS, "file_checksum", "source_file", instant(as_of).alias("loaded_at")
    )
    manifests = complete.select(
        "mission_id",
        "mission_date",
        "manifest_path",
        F.col("object_key").alias("mission_file"),
        unpack_hex(F.col("checksum")).alias("checksum_mission"),
        unpack_hex(F.col("checksum_manifest")).alias("checksum_manifest"),
        utc_text_to_ntz(F.col("upload_time")).alias("upload_time"),
        F.lit(C.INGESTED).alias("status"),
    )
    waiting = settled.where(F.col("newest_run").isNull()).select("mission_id", "mission_date", "manifest_path")
    states = _states(complete, as_of)
    left_out = of_new(judged.where(F.col("_misfit").isNotNull())).select(
        F.col("source_file").alias("source"), F.lit("report row does not fit").alias("reason"), F.col("_misfit").alias("detail")
    )
    dropped = states.withColumn("_misfit", _misfits(states, SHIP_STATE)).where(F.col("_misfit").isNotNull()).select(
        F.col("source_file").alias("source"), F.lit("reading does not fit").alias("reason"), F.col("_misfit").alias("detail")
    )
    rejected = unreadable_manifests(documents).unionByName(left_out).unionByName(dropped)
    return Landing(land(reports, MISSION_REPORTS), land(states, SHIP_STATE), land(manifests, MANIFESTS), waiting, rejected)


def _any_present(struct: str) -> Column:
    """True when the struct holds any value: an empty object counts as absent.

    Its JSON text leaves out nulls, so only a value puts something other than ``{`` behind a colon. One expression on
    the whole struct also keeps the optimizer's constraint set small; a disjunction over all leaves does not.
    """
    return F.coalesce(F.to_json(struct).rlike(":[^{]"), F.lit(False))


def _states(new: DataFrame, as_of: datetime | str) -> DataFrame:
    nested = _any_present("ship_state.coordinates")

    def state(name: str, default=None) -> Column:
        col = F.col(f"ship_state.{name}")
        return col if default is None else F.coalesce(col, F.lit(default))

    def axis(name: str) -> Column:
        inside = F.coalesce(state(f"coordinates.{name}_km"), F.lit(0.0))
        return F.when(nested, inside).otherwise(state(f"coord_{name}"))

    # A mission's states must differ in time (they are keyed by it): each day's comes a microsecond after the last.
    day_number = F.date_diff("mission_date", F.lit("1970-01-01").cast("date"))
    ingested_at = instant(as_of) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), day_number / F.lit(1_000_000).cast("decimal(8,0)"))
    planet = F.when(nested, state("coordinates.planet")).otherwise(state("planet"))
    return new.where(_any_present("ship_state")).select(
        "mission_id",
        ingested_at.alias("timestamp"),
        state("ship_condition", C.UNKNOWN).alias("ship_condition"),
        state("normalized_health_total").alias("normalized_health_total"),
        *[state(f"health_scores.{s}").alias(f"{s}_health") for s in ("motor", "engine", "core", "fuel")],
        state("fuel_prc", 0.0).alias("fuel_prc"),
        F.coalesce(state("temperature_C"), state("motor_temp_c"), F.lit(0.0)).alias("temperature_C"),
        state("radiation_uSv", 0.0).alias("radiation_uSv"),
        state("cargo_integrity_prc", 100.0).alias("cargo_integrity_prc"),
        *[axis(a).alias(f"coord_{a}") for a in ("x", "y", "z")],
        F.coalesce(planet, F.lit(C.UNKNOWN)).alias("planet"),
        unpack_hex(F.col("checksum")).alias("file_checksum"),
        F.col("object_key").alias("source_file"),
        instant(as_of).alias("loaded_at"),
    )
