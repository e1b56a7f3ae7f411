"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and executes the full plan into Spark's ``noop`` sink (no
collect, no output files). One warm-up pass, then the median of ``$BENCH_REPEATS``
timed runs per query. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mart_customer_360",
    "mart_orders_enriched",
    "mart_sales_state_category_month",
    "mart_customer_basic",
    "rfm_scores",
    "rfm_segments",
    "dq_report",
    "prof_all",
    "pipeline_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from basketry import registry
    from basketry.session import get_session

    spark = get_session(
        "basketry-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, cpus * 2),
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up: JIT, file listing caches, Python imports
        run(name)
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
