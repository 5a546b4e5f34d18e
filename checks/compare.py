"""Run registered queries against their SQL in DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks.suite import ORACLES, QUERIES
from wakeline.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(float(value)) if isinstance(value, float) else f"{type(value).__name__}:{value}"


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    left_names, left = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return ""
    got = con.execute(ORACLES[name])
    right_names, right = rows_of([d[0] for d in got.description], got.fetchall())
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; only left {list(set(left) - set(right))[:2]}, only right {list(set(right) - set(left))[:2]}"
    if left != right:
        diff = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(diff)} rows differ, e.g. {diff[0]}"
    return ""


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begin:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
