"""File names, object keys, states, JSON and hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wakeline import catalogue as C


def normal_status(status: Column) -> Column:
    return F.upper(status)


def flag(state: Column, value: str) -> Column:
    """1.0 when ``state`` equals ``value`` in any letter case, else 0.0 (also for null)."""
    return F.when(F.upper(state) == value, 1.0).otherwise(0.0)


def ship_or_unknown(ship_id: Column) -> Column:
    return F.coalesce(F.nullif(ship_id, F.lit("")), F.lit(C.UNKNOWN))


def _labels(state: Column, labels: dict[str, str], default: str) -> Column:
    col = None
    for value, label in labels.items():
        col = F.when(state == value, label) if col is None else col.when(state == value, label)
    return col.otherwise(default)


def status_colour(status: Column) -> Column:
    """Radar dot colour."""
    return _labels(status, C.STATUS_COLOURS, C.DEFAULT_COLOUR)


def status_marker(status: Column) -> Column:
    """Marker of a status-change log line."""
    return _labels(status, C.STATUS_MARKERS, C.DEFAULT_MARKER)


def file_stem(name: Column) -> Column:
    """File name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def stem_mission_id(stem: Column) -> Column:
    """First all-digit part after the first ``_`` that is shorter than a date, else ``unknown``."""
    parts = F.split(stem, "_")
    rest = F.slice(parts, F.lit(2), F.size(parts))
    numeric = F.filter(rest, lambda p: p.rlike("^[0-9]+$") & (F.length(p) < 8))
    return F.coalesce(F.try_element_at(numeric, F.lit(1)), F.lit("unknown"))


def stem_log_type(stem: Column) -> Column:
    return F.when(stem.contains("_"), F.split(stem, "_")[0]).otherwise("file")


def object_key(kind: str, suffix: str, mission_id: Column, day: Column) -> Column:
    """``{mission}/{yyyy-MM-dd}/{kind}_{mission}_{yyyyMMdd}.{suffix}``."""
    mission = mission_id.cast("string")
    name = F.concat(F.lit(f"{kind}_"), mission, F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit(f".{suffix}"))
    return F.concat_ws("/", mission, F.date_format(day, "yyyy-MM-dd"), name)


def report_key(mission_id: Column, day: Column) -> Column:
    return object_key("mission", "parquet", mission_id, day)


def manifest_key(mission_id: Column, day: Column) -> Column:
    return object_key("manifest", "json", mission_id, day)


def encode_json(*columns: Column | str) -> Column:
    """JSON text of the columns, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def pack_hex(text: Column) -> Column:
    """``bytes, text``: lower-case hex text as its bytes, half as long; any other text as it is."""
    content = F.unhex(text)
    fits = F.lower(F.hex(content)) == text
    return F.struct(F.when(fits, content).alias("bytes"), F.when(~F.coalesce(fits, F.lit(False)), text).alias("text"))


def unpack_hex(packed: Column) -> Column:
    """The text that ``pack_hex`` was given."""
    return F.coalesce(F.lower(F.hex(packed["bytes"])), packed["text"])
