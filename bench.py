"""Timings of the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.suite import QUERIES  # noqa: E402
from wakeline.session import build_session  # noqa: E402

HEADLINE = (
    "mart_ship_performance",
    "mart_fleet_kpis",
    "mart_captain_performance",
    "mart_planet_performance",
    "bl_mission_summary",
    "bl_cargo_summary",
    "bl_manifest_summary",
    "bl_planet_summary",
    "upsert_mission_summary",
    "upsert_cargo_summary",
    "upsert_manifest_summary",
    "upsert_planet_summary",
    "health_scores",
    "ship_state_landing",
    "mission_reports_landing",
    "manifest_states_landing",
    "clean_reports",
    "register_missions",
    "complete_missions",
    "radar_latest",
    "radar_transitions",
    "telemetry_parse_roundtrip",
    "telemetry_metrics_latest",
    "mission_outcomes",
    "report_snapshots",
    "dq_pk_duplicates",
    "dq_fk_orphans",
    "cascade_prune",
    "stream_lake",
    "stream_metrics",
    "stream_radar_latest",
    "stream_radar_transitions",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to compute every row of a query, without shipping them to the driver."""
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the executors
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
