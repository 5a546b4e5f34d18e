"""Table schemas with column comments, and the cast that lands a DataFrame in one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from wakeline import catalogue as C

TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TIME, DATE, D = T.TimestampNTZType(), T.DateType(), T.DecimalType


def struct(comments: dict[str, str] | None = None, required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    """A struct type from ``name=type`` pairs, with column comments as field metadata."""
    notes = comments or {}
    return T.StructType(
        [T.StructField(n, t, n not in required, {"comment": notes[n]} if n in notes else {}) for n, t in fields.items()]
    )


TELEMETRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in C.TELEMETRY_STRINGS]
    + [T.StructField(n, T.DoubleType()) for n in C.TELEMETRY_NUMBERS]
    + [T.StructField(n, T.StringType()) for n in C.TELEMETRY_STATES]
)

MISSIONS = struct(
    mission_id=LONG,
    ship_name=TEXT,
    captain=TEXT,
    target=TEXT,
    report_freq_min=INT,
    status=TEXT,
    started_at=TIME,
    finished_at=TIME,
    updated_at=TIME,
    comments={
        "status": "Mission outcome: RUNNING, SUCCESS or FAILURE.",
        "started_at": "When the mission was registered.",
        "finished_at": "When the mission was completed.",
        "updated_at": "Refreshed on every change of the row.",
    },
    required=("mission_id", "ship_name", "captain", "target", "report_freq_min"),
)

SHIP_STATE = struct(
    mission_id=LONG,
    timestamp=TIME,
    status=TEXT,
    ship_condition=TEXT,
    normalized_health_total=D(4, 3),
    motor_health=D(4, 3),
    engine_health=D(4, 3),
    core_health=D(4, 3),
    fuel_health=D(4, 3),
    fuel_prc=D(5, 2),
    temperature_C=D(5, 1),
    radiation_uSv=D(8, 3),
    cargo_integrity_prc=D(5, 2),
    coord_x=D(18, 0),
    coord_y=D(18, 0),
    coord_z=D(18, 0),
    planet=TEXT,
    file_checksum=TEXT,
    source_file=TEXT,
    loaded_at=TIME,
    comments={
        "status": "Operational status: OK, REPAIR or FAILURE.",
        "ship_condition": "Condition label derived from the health scores.",
        "normalized_health_total": "Overall health, 0 to 1.",
        "motor_health": "Motor score, 0 to 1.",
        "engine_health": "Engine score, 0 to 1.",
        "core_health": "Power core score, 0 to 1.",
        "fuel_health": "Fuel score, 0 to 1.",
    },
)

MANIFESTS = struct(
    mission_id=LONG,
    mission_date=DATE,
    manifest_path=TEXT,
    mission_file=TEXT,
    checksum_mission=TEXT,
    checksum_manifest=TEXT,
    upload_time=TIME,
    status=TEXT,
    comments={"manifest_path": "Object key of the manifest document."},
)

MISSION_REPORTS = struct(
    mission_id=LONG,
    item=TEXT,
    value=D(18, 2),
    timestamp=TIME,
    file_checksum=TEXT,
    source_file=TEXT,
    loaded_at=TIME,
    comments={"value": "Price of the reported item."},
)

RAW_REPORT = struct(
    mission_id=TEXT,
    item=TEXT,
    value=DOUBLE,
    timestamp=TEXT,
)
REPORT_COLUMNS = tuple(RAW_REPORT.names)

STATE_COORDINATES = struct(x_km=DOUBLE, y_km=DOUBLE, z_km=DOUBLE, planet=TEXT)
STATE_SCORES = struct(motor=DOUBLE, engine=DOUBLE, core=DOUBLE, fuel=DOUBLE)
MANIFEST_DOCUMENT = struct(
    mission_id=TEXT,
    date=TEXT,
    files=struct(mission=TEXT),
    checksum=struct(mission=TEXT),
    ship_state=struct(
        timestamp=TEXT,
        mission_id=TEXT,
        ship_id=TEXT,
        coord_x=DOUBLE,
        coord_y=DOUBLE,
        coord_z=DOUBLE,
        planet=TEXT,
        coordinates=STATE_COORDINATES,
        fuel_prc=DOUBLE,
        motor_temp_c=DOUBLE,
        engine_pressure_kpa=DOUBLE,
        power_core_temp_c=DOUBLE,
        temperature_C=DOUBLE,
        radiation_uSv=DOUBLE,
        cargo_integrity_prc=DOUBLE,
        status=TEXT,
        health_scores=STATE_SCORES,
        normalized_health_total=DOUBLE,
        ship_condition=TEXT,
    ),
    upload_time=TEXT,
)

#: What an ingest run could not take, and the manifests that wait for their report.
REJECTED = struct(source=TEXT, reason=TEXT, detail=TEXT)
WAITING = struct(manifest_path=TEXT, text=TEXT)

#: Column widths declared for text columns: table -> {column: (shortest, longest)}.
TEXT_WIDTHS = {
    "ship_state": {"planet": (0, 255), "file_checksum": (64, 64)},
    "manifests": {"checksum_mission": (64, 64), "checksum_manifest": (64, 64)},
    "mission_reports": {"file_checksum": (64, 64)},
}


def land(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name, cast to its types and attach its comments.

    A value that does not fit becomes null instead of failing the job; ``quality.numeric_overflow`` on the input
    lists such values. Columns the input lacks are null.
    """
    have = dict(df.dtypes)
    out = []
    for field in schema.fields:
        if field.name not in have:
            col = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType.simpleString():
            col = F.col(field.name)
        else:
            col = F.col(field.name).try_cast(field.dataType)
        out.append(col.alias(field.name, metadata=field.metadata) if field.metadata else col.alias(field.name))
    return df.select(*out)


def column_comments(schema: T.StructType) -> dict[str, str]:
    """Comments of a schema, by column."""
    return {f.name: f.metadata["comment"] for f in schema.fields if "comment" in f.metadata}
