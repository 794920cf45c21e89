"""Time the headline queries; print one JSON line.

Each query runs once to warm the JVM and once timed. Time covers building the plan, planning and
running it to a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "score_all", "all_rounds_long", "dedup_latest", "dedup_latest_events", "dedup_colmax",
    "decode_first", "decode_later", "join_region_left", "round_bc", "round_ep",
    "round_pp", "round_pp_party", "run_all_states", "combine_rounds_wide", "report_page",
    # the queries with the largest plans, and the same round with one scan and with one per branch
    "combine_scopes", "materialise_join", "stack_rounds", "round_com", "score_rounds_dense", "report_full",
    "round_bc_from_tables", "round_by_branch",
    # batches, buckets, branches as a table, time, levels
    "run_incremental", "run_by_number", "match_stored_branches", "calls_in_windows", "schedule_in_force",
    "call_sessions", "distinct_respondents", "duration_percentiles",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from workload.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("surveyscore-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        timed(name)
    seconds = {name: round(timed(name), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
