"""Captain reports: periodic state snapshots, manifest documents, upload audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline import catalogue as C
from wakeline.functions.health import SCORES, score_health
from wakeline.functions.text import encode_json, file_stem, manifest_key, report_key, sha256_hex, stem_log_type, stem_mission_id
from wakeline.functions.times import far_future, file_time_tag, instant, iso_seconds, utc_text_to_ntz
from wakeline.operators.arrival import latest_per_key
from wakeline.operators.skew import sliced_join
from wakeline.plans.radar import is_terminal

_STATE = ("timestamp", "ship_id", *C.TELEMETRY_NUMBERS)
#: Report numbers that one row spreads out into.
_SPAN = 4096


def report_snapshots(
    missions: DataFrame,
    telemetry: DataFrame,
    as_of: datetime | str,
    order: str = "seq",
    period_seconds: Column | None = None,
    anchor: Column | None = None,
) -> DataFrame:
    """Reported states per mission by ``as_of``: the first tick, the last tick before every report time, the ending tick.

    Report times are ``anchor`` plus whole periods; ``period_seconds`` defaults to the mission's report frequency and
    ``anchor`` to its start. A report is due at its time, whether or not something arrived in its period: it shows the last known
    state. Reports end with the mission. Nothing after ``as_of`` is reported or looked at, so a later run repeats all
    earlier reports. A period that is null or not positive gives no periodic reports. Output: ``mission_id, report_no, kind`` (start, periodic, final), the state with its health. The
    final report carries the mission's outcome as status.

    The join with the mission's period slices hot missions; right after it the ticks are reduced to three states per
    (mission, period), in one pass. Empty periods are filled from the state before them, one row per report.
    """
    period = F.col("report_freq_min") * 60 if period_seconds is None else period_seconds
    begin = F.col("started_at") if anchor is None else anchor
    period = F.when(period > 0, period.cast("bigint"))
    due = F.floor(F.timestamp_diff("SECOND", begin, instant(as_of)) / period).cast("bigint")
    plan = missions.select("mission_id", period.alias("_period"), begin.alias("_begin"), due.alias("_due"))
    typed = telemetry.withColumns(
        {"mission_id": F.col("mission_id").try_cast("bigint"), "_at": utc_text_to_ntz(F.col("timestamp"))}
    ).where(F.col("_at") <= instant(as_of))
    ticks = sliced_join(typed, plan, "mission_id", F.col(order))
    seconds = F.timestamp_diff("SECOND", F.col("_begin"), F.col("_at"))
    ticks = ticks.withColumn("_slot", F.floor(seconds / F.col("_period")).cast("bigint"))

    seq, ends = F.col(order), is_terminal()
    live = F.when(F.col("status") == C.REPAIR, F.lit(C.REPAIR)).otherwise(C.OK).alias("status")
    live_state = F.struct(*_STATE, live)
    end_state = F.struct(*_STATE, F.col("mission_status").alias("status"))
    slots = ticks.groupBy("mission_id", "_slot").agg(
        F.max("_due").alias("_due"),
        F.min(seq).alias("first_seq"),
        F.min_by(live_state, seq).alias("first"),
        F.max_by(live_state, seq).alias("last"),
        F.min(F.when(ends, seq)).alias("end_seq"),
        F.min_by(end_state, F.when(ends, seq)).alias("end"),
    )
    # From here on there is one row per mission and period that has ticks.
    mission = Window.partitionBy("mission_id")
    ending = F.min(F.when(F.col("end_seq").isNotNull(), F.struct("end_seq", "_slot"))).over(mission)
    following = F.lead("_slot").over(mission.orderBy("_slot"))
    marked = slots.withColumns({"_begin_seq": F.min("first_seq").over(mission), "_ending": ending, "_next": following})

    # A slot's last state is shown by the report that closes it and by those up to the next slot with ticks.
    upto = F.least("_due", F.coalesce("_next", "_due"), F.coalesce("_ending._slot", "_due"))
    from_ = F.greatest(F.col("_slot") + 1, F.lit(1))
    after = F.coalesce("_slot", F.lit(0)) + 1

    def span(condition: Column, kind: str, low: Column, high: Column) -> Column:
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high")))

    spans = F.array(
        span(F.col("first_seq") == F.col("_begin_seq"), "start", F.lit(0), F.lit(0)),
        span(F.col("_slot").isNotNull() & (from_ <= upto), "periodic", from_, upto),
        span(F.col("end_seq") == F.col("_ending.end_seq"), "final", after, after),
    )
    # Numbers are spread out before a state is attached, _SPAN of them at a time: no row holds many states or many numbers.
    listed = marked.select("mission_id", "first", "last", "end", F.inline(F.filter(spans, lambda x: x.isNotNull())))
    parts = listed.withColumn("_part", F.explode(F.sequence("low", "high", F.lit(_SPAN).cast("bigint"))))
    each = parts.withColumn("report_no", F.explode(F.sequence("_part", F.least("high", F.col("_part") + _SPAN - 1))))
    state = F.when(F.col("kind") == "start", F.col("first")).when(F.col("kind") == "final", F.col("end")).otherwise(F.col("last"))
    out = each.select("mission_id", "report_no", "kind", state.alias("state"))
    return score_health(out.select("mission_id", "report_no", "kind", "state.*"))


def state_struct(snapshot_columns: list[str]) -> Column:
    """A snapshot row as the ``ship_state`` object of a manifest (flat layout)."""
    flat = [c for c in snapshot_columns if c in (*_STATE, "status", "normalized_health_total", "ship_condition")]
    scores = F.struct(*[F.col(s).alias(s.removesuffix("_health")) for s in SCORES])
    return F.struct(*flat, scores.alias("health_scores"))


def with_object(reports: DataFrame) -> DataFrame:
    """Cleaned report rows with mission and day as one value, ``object``, nulls included."""
    day = F.substring(F.col("timestamp").cast("string"), 1, 10).cast("date")
    return reports.withColumn("object", F.struct("mission_id", day.alias("mission_date")))


def report_objects(reports: DataFrame) -> DataFrame:
    """One row per (mission, day) of cleaned report rows: ``mission_id, mission_date, object_key, checksum, sha256, object``.

    The checksum covers the rows' content whatever their order or files: the SHA-256 of every row is taken apart into eight
    numbers of 32 bits, these are added up exactly, and count and sums are hashed. All merge map-side, so a hot object is
    never gathered in one place. The sums are longs, exact up to two billion rows an object. ``object`` is mission and day
    as one value, nulls included, by which the rows are dealt out: a join by it deals out nothing again, and rows that have
    it (``with_object``) and met by it before aren't dealt out here.
    """
    fields = [F.col("item"), F.col("value").cast("decimal(38,9)").cast("string"), F.col("timestamp").cast("timestamp_ntz").cast("string")]
    text = F.concat_ws("|", *[F.coalesce(f, F.lit("")) for f in fields])
    placed = reports if "object" in reports.columns else with_object(reports)
    hashed = placed.select("object", sha256_hex(text.cast("binary")).alias("_hash"))
    limbs = [F.conv(F.substring("_hash", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]
    sums = [F.sum(limb).alias(f"_{i}") for i, limb in enumerate(limbs)]
    objects = hashed.groupBy("object").agg(F.count(F.lit(1)).alias("_n"), *sums)
    digest = sha256_hex(F.concat_ws("|", *[F.col(c).cast("string") for c in ("_n", *[f"_{i}" for i in range(8)])]).cast("binary"))
    mission, date = F.col("object.mission_id"), F.col("object.mission_date")
    keyed = objects.select(
        mission.alias("mission_id"), date.alias("mission_date"), report_key(mission, date).alias("object_key"), digest.alias("checksum"), "object"
    )
    return keyed.select("mission_id", "mission_date", "object_key", "checksum", F.col("checksum").alias("sha256"), "object")


def build_manifests(files: DataFrame, states: DataFrame, as_of: datetime | str) -> DataFrame:
    """Manifest documents ``manifest_path, text``, one per report file.

    ``files``: ``mission_id, mission_date, object_key, checksum`` (``report_objects``). ``states``: ``mission_id, ship_state`` and, when
    the state differs by day, ``mission_date``. A later report of a day replaces the earlier object.
    """
    keys = [k for k in ("mission_id", "mission_date") if k in states.columns]
    upload = iso_seconds(far_future(F.date_trunc("day", instant(as_of)).cast("timestamp_ntz") + F.expr("INTERVAL '18' HOUR")))
    text = encode_json(
        F.col("mission_id").cast("string").alias("mission_id"),
        F.date_format("mission_date", "yyyy-MM-dd").alias("date"),
        F.struct(F.col("object_key").alias("mission")).alias("files"),
        F.struct(F.col("checksum").alias("mission")).alias("checksum"),
        "ship_state",
        upload.alias("upload_time"),
    )
    path = manifest_key(F.col("mission_id"), F.col("mission_date"))
    return files.join(states, keys, "left").select(path.alias("manifest_path"), text.alias("text"))


def latest_states(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot per mission as ``mission_id, ship_state``; the final report outranks the last periodic one."""
    order = F.col("report_no") * 2 + F.when(F.col("kind") == "final", 1).otherwise(0)
    ranked = snapshots.select("mission_id", state_struct(snapshots.columns).alias("ship_state"), order.alias("_order"))
    return latest_per_key(ranked, ["mission_id"], "_order").select("mission_id", "ship_state")


def upload_audit_log(files: DataFrame, as_of: datetime | str) -> DataFrame:
    """Audit events of uploaded files, stamped in the reporting calendar, with the object key they are stored under.

    ``files``: ``file_name, source_bucket, checksum, success`` and optionally ``mission_id``, else read from the name.
    """
    stem = file_stem(F.col("file_name"))
    given = F.nullif(F.col("mission_id").cast("string"), F.lit("")) if "mission_id" in files.columns else F.lit(None)
    mission = F.coalesce(given, stem_mission_id(stem))
    at = far_future(instant(as_of))
    rows = files.select(
        iso_seconds(at).alias("timestamp"),
        mission.alias("mission_id"),
        "file_name",
        "source_bucket",
        F.when(F.col("success"), "SUCCESS").otherwise("FAIL").alias("status"),
        "checksum",
        F.date_format(at, "yyyy-MM-dd").alias("log_date"),
        stem_log_type(stem).alias("log_type"),
    )
    name = F.concat(F.lit("log_"), F.col("log_type"), F.lit("_"), F.col("mission_id"), F.lit("_"), file_time_tag(at), F.lit(".json"))
    key = F.concat(F.col("log_date"), F.lit("/mission_"), F.col("mission_id"), F.lit("/"), name)
    return rows.withColumn("object_key", key).drop("log_type")


