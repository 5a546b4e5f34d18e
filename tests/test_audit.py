"""Audit events as files."""

from pathlib import Path

from tests.conftest import rows
from wakeline.sinks.files import write_audit_log


def test_events_of_a_day_are_compressed(spark, table, tmp_path):
    events = table([("1", "2025-01-01", "k1"), ("2", "2025-01-02", "k2")], "mission_id string, log_date string, object_key string")
    write_audit_log(events, str(tmp_path / "a"))
    files = [p.name for p in Path(tmp_path / "a").rglob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    got = spark.read.json(str(tmp_path / "a"))
    assert rows(got.select("mission_id", "object_key")) == [("1", "k1"), ("2", "k2")]
