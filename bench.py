"""Headline queries at one scale: one warm-up, then the median of three runs each (one run for
queries whose warm-up took more than ten seconds).

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_ONLY takes a
comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.plans.registered import QUERIES  # noqa: E402
from tributary.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def by_name(name):
    return lambda spark: QUERIES[name](spark, SF_DIR)


BENCH = {
    "statement_edges": by_name("P4_flink_edges"),
    "topic_throughput": by_name("A3_topic_throughput"),
    "consumer_groups": by_name("A1_consumer_groups"),
    "lineage_edges": by_name("U1_lineage_edges"),
    "job_events": by_name("A4_job_events"),
    "diff_history": by_name("W3_diff_history"),
    "diff_cycle": by_name("J7_diff_cycle"),
    "minute_rollup": by_name("A12_metric_minute_rollup"),
    "flatten_schemas": by_name("X1_flatten_schemas"),
    "reach_closure": by_name("G2_reach"),
    "components": by_name("G3_components"),
    "orders_enriched": by_name("P14_enrich_orders"),
}


def run(spark, make) -> float:
    start = time.perf_counter()
    make(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session("bench", cpus=CPUS, memory=os.environ.get("BENCH_MEMORY", "8g"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    seconds = {}
    for name, make in BENCH.items():
        if only and name not in only:
            continue
        warm_up = run(spark, make)
        runs = RUNS if warm_up < 10 else 1
        seconds[name] = round(statistics.median(run(spark, make) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }), flush=True)


if __name__ == "__main__":
    main()
