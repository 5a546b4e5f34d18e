"""Every registered query against its SQL counterpart on the smallest data."""

import pytest

from checks import sql as Q
from checks.compare import compare, connect
from checks.suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES
    assert compare(spark, con, name, SF) == ""


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 23


def test_snapshots_cover_the_whole_table(spark, con):
    """Every mission with an ending tick, however late, has its final report."""
    kinds = [r.kind for r in QUERIES["report_snapshots"](spark, SF).collect()]
    ended = "SELECT count(DISTINCT mission) FROM seen WHERE mission_status IS NOT NULL"
    seen = ", ".join([Q.MISSIONS, Q.TELEMETRY, "seen AS (SELECT t.* FROM telemetry t JOIN missions m ON m.mission_id = t.mission)"])
    assert kinds.count("final") == con.execute(f"WITH {seen} {ended}").fetchone()[0] > 0
