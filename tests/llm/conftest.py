import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text[, lang[, source]]) tuples."""

    def make(rows, more=""):
        full = [(r[0], r[1], *(list(r[2:]) + [None] * (4 - len(r)))[:2], None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in more.split():
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make
