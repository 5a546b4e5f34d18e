"""Checks, key relationships, registry and dimensions."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from wakeline.operators import keys as K, quality as DQ, registry as R
from wakeline.schemas import MISSIONS, SHIP_STATE, TEXT_WIDTHS, column_comments, land
from wakeline.sources.dimensions import cargo_items, planets, unknown_targets, with_arrival, with_target_position

NOW = datetime(2025, 1, 1)


def test_dimensions(spark):
    assert planets(spark).count() == 21 and cargo_items(spark).count() == 23
    assert cargo_items(spark).agg(F.sum("value")).first()[0] == 6150


def test_arrival(spark, table):
    ticks = table([(0.7e8 - 2.4e6, -1.3e8, -1.5e8, "PNF-404"), (0.7e8 - 2.5e6, -1.3e8, -1.5e8, "PNF-404"), (0.0, 0.0, 0.0, "Nowhere")],
                  "coord_x double, coord_y double, coord_z double, target string")
    placed = with_arrival(with_target_position(ticks, planets(spark)))
    got = {(r["target"], r["coord_x"]): r["arrived"] for r in placed.collect()}
    assert got == {("PNF-404", 0.7e8 - 2.4e6): True, ("PNF-404", 0.7e8 - 2.5e6): False, ("Nowhere", 0.0): None}
    assert rows(unknown_targets(ticks, planets(spark)).select("target")) == [("Nowhere",)]


def test_landing_cast_rounds_and_nulls_what_does_not_fit(table):
    df = table([(99.995, -2.5, 1000.0, "1")], "fuel_prc double, coord_x double, normalized_health_total double, mission_id string")
    row = land(df, SHIP_STATE).first()
    assert (str(row["fuel_prc"]), row["coord_x"], row["normalized_health_total"], row["mission_id"]) == ("100.00", -3, None, 1)
    assert rows(DQ.numeric_overflow(df, "ship_state", SHIP_STATE)) == [("ship_state", "numeric_overflow", "normalized_health_total", 1)]


def test_text_width(table):
    df = table([("x" * 64, "y" * 256), ("short", None)], "file_checksum string, planet string")
    assert rows(DQ.text_width(df, "ship_state")) == [("ship_state", "text_width", "file_checksum", 1), ("ship_state", "text_width", "planet", 1)]
    assert set(TEXT_WIDTHS) == {"ship_state", "manifests", "mission_reports"}


def test_keys(table):
    children = table([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "mission_id bigint, x string")
    parents = table([(1,)], "mission_id bigint")
    assert rows(DQ.foreign_key(children, parents, "t", "mission_id")) == [("t", "foreign_key", "2", 2)]
    assert rows(K.cascade(children, parents, "mission_id").select("x")) == [("a",), ("d",)]
    assert rows(DQ.primary_key(children, "t", ["mission_id"])) == [("t", "primary_key", "2", 2)]
    assert rows(DQ.not_null(children, "t", ["mission_id", "x"])) == [("t", "not_null", "mission_id", 1)]
    assert rows(DQ.status_domain(table([("RUNNING",), ("LOST",), (None,)], "status string"), "missions")) == [("missions", "status_domain", "LOST", 1)]
    assert DQ.single_row(parents, "t").count() == 0 and rows(DQ.single_row(parents.limit(0), "t")) == [("t", "single_row", "rows", 0)]
    assert rows(K.departed(table([("a",), ("b",)], "id string"), table([("b",)], "id string"), "id")) == [("a",)]


def test_tables(spark, table, tmp_path):
    from wakeline.sources.tables import read_table

    df = table([(1,)], "v int")
    df.write.parquet(str(tmp_path / "t"))
    df.createOrReplaceTempView("some_table")
    assert rows(read_table(spark, str(tmp_path / "t"), "parquet")) == rows(read_table(spark, "some_table")) == [(1,)]


def test_registry(spark, table):
    empty = spark.createDataFrame([], MISSIONS)
    ask = table([(20, "S2", "C", "P", 1), (10, "S1", "C", "P", 2)], "request_id bigint, ship_name string, captain string, target string, report_freq_min int")
    first = R.register(empty, ask, NOW)
    assert rows(first.select("mission_id", "ship_name", "status", "started_at", "finished_at", "updated_at"), "mission_id") == [
        (1, "S1", "RUNNING", NOW, None, NOW),
        (2, "S2", "RUNNING", NOW, None, NOW),
    ]
    second = R.register(first, ask, NOW)
    assert rows(second.select("mission_id")) == [(1,), (2,), (3,), (4,)]
    later = datetime(2025, 1, 2)
    commands = table([(1, 2, "failure"), (2, 2, "success"), (3, 99, "success")], "command_id bigint, mission_id bigint, status string")
    done, missing = R.complete(first, commands, later)
    assert rows(done.select("mission_id", "status", "finished_at", "updated_at"), "mission_id") == [
        (1, "RUNNING", None, NOW),
        (2, "SUCCESS", later, later),
    ]
    assert rows(missing) == [(99,)]
    touched = R.touch_parents(done, table([(1, datetime(2025, 1, 5)), (2, datetime(2024, 1, 1))], "mission_id bigint, loaded_at timestamp_ntz"))
    assert rows(touched.select("mission_id", "updated_at"), "mission_id") == [(1, datetime(2025, 1, 5)), (2, later)]


def test_comments(spark):
    assert len(column_comments(SHIP_STATE)) == 7
    assert land(spark.createDataFrame([(1,)], "mission_id bigint"), SHIP_STATE).schema["status"].metadata["comment"]
