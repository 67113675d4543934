"""Wall time of the headline queries: median of the runs after a warm-up, one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fairwait.session import build_session, scratch_path  # noqa: E402
from fairwait.sinks import read_snapshot, replace_table  # noqa: E402
from fairwait.plans import marts, reports  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload import bindings as b  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# From the given tables.
WHOLE = [
    "request_facts",
    "tract_stats",
    "equity_score",
    "gap_by_type",
    "pooled_trend",
    "dedup_latest",
    "stage_requests",
    "ntile_bucket_ranged",
    "point_in_polygon_join",
    "point_in_polygon_join_shuffled",
    "upsert_latest",
]
# From the stored splits mart, as reports run.
REPORTS = {
    "report_map": lambda s: reports.map_rollup(s, "type", ["AFRICA", "ASIA", "EUROPE"], "1-URGENT", floor=b.ROW_FLOOR),
    "report_quintiles": lambda s: reports.quintile_profile(s, b.ROW_FLOOR),
    "report_boroughs": lambda s: reports.borough_quintile_score(s, b.ROW_FLOOR),
    "report_trend": lambda s: reports.score_trend(s, floor=b.ROW_FLOOR),
    "report_top_types": lambda s: reports.top_complaints(s, floor=b.ROW_FLOOR),
}


def timed(make) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    spark = build_session(
        "fairwait-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda n=name: QUERIES[n](spark, SF)) for name in WHOLE}

    path = scratch_path(spark, "splits")
    fact, dim = b.fact(spark, SF), b.dim(spark, SF)
    start = time.perf_counter()
    replace_table(marts.equity_score(fact, dim), path)
    seconds["store_splits"] = round(time.perf_counter() - start, 3)
    splits = read_snapshot(spark, path)
    for name, make in REPORTS.items():
        seconds[name] = timed(lambda m=make: m(splits))

    # Whole runs, once each: they write tables.
    for name in ("run_backfill", "build_marts"):
        start = time.perf_counter()
        QUERIES[name](spark, SF).count()
        seconds[name] = round(time.perf_counter() - start, 3)

    requests = b.table(spark, SF, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF,
                "cpus": int(CPUS),
                "requests": requests,
                "requests_per_sec": {
                    n: round(requests / seconds[n]) for n in ("request_facts", "equity_score", "gap_by_type", "pooled_trend")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
