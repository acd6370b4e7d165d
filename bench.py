"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidelog.catalog.queries import QUERIES
from tidelog.session import local_session

HEADLINE = [
    "a20_product_metrics", "a3_executive_summary", "a4_user_adoption", "a5_tool_usage", "a7_project_activity",
    "a1_session_summary", "a13_period_metrics", "a17_usage_by_day", "a31_schema_drift", "a32b_context_blobs",
    "a33_artifact_profile", "d3_backfill", "d4_refresh_context", "p3_sql_events", "q1_validate_events",
    "s1_parse_lines", "w1_activity_occurrences", "w6_self_study_sessions", "w7_latest_per_customer",
    "w8_dedup_keep_first", "t1_ingest_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tidelog-bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("a8_orphaned_sessions")  # warms the JVM
    times = {}
    for name in names:
        times[name] = round(min(run(name), run(name)), 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
