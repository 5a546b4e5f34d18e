"""Documents stored by run."""

from pyspark.sql import functions as F

from tests.conftest import rows
from wakeline.sinks.files import write_manifest_documents
from wakeline.sources.files import read_manifest_rows


def test_newest_document_of_each_path(spark, table, tmp_path):
    runs = [[("a", "a0"), ("b", "b0"), (None, "n0")], [("b", "b1"), ("c", "c1")], [("a", "a2"), ("d", "d2"), ("d", "d2"), (None, "n2")]]
    for number, docs in enumerate(runs):
        write_manifest_documents(table(docs, "manifest_path string, text string"), str(tmp_path / "d"), number)
    got = read_manifest_rows(spark, str(tmp_path / "d"))
    assert rows(got) == [(None, "n2"), ("a", "a2"), ("b", "b1"), ("c", "c1"), ("d", "d2")]


def test_texts_of_the_last_run_are_not_dealt_out(spark, table, tmp_path):
    docs = spark.range(2000).select(F.col("id").cast("string").alias("manifest_path"), F.lit("t").alias("text"))
    for number in (0, 1):
        write_manifest_documents(docs, str(tmp_path / "d"), number)
    plan = read_manifest_rows(spark, str(tmp_path / "d"))._jdf.queryExecution().executedPlan().toString()
    first = plan.split("+- Union")[-1] if "+- Union" in plan else plan
    assert "Exchange" not in first.split("FileScan", 1)[0].replace("BroadcastExchange", "")
