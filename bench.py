"""Benchmark: headline queries on one scale, one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3).  Each query runs once untimed (plan building,
     code generation, JIT), then BENCH_REPEAT timed runs; ``queries`` holds
     the median, ``queries_min`` the fastest run.

Small results are collected to the driver; row-level results are written
to Spark's ``noop`` sink, which runs the whole plan without storing it.
The end-to-end pipeline (bronze ingest -> gate -> silver -> gold, all
tables written as Parquet) runs once untimed, then once timed, each time on
CSVs landed beforehand into a fresh folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

# query -> how to run it: "collect" (small result) or "noop" (row-level)
HEADLINE = {
    "mart_daily_sales": "collect",
    "mart_state_performance": "collect",
    "mart_category_performance": "collect",
    "mart_order_status_daily": "collect",
    "dq_gate_summary": "collect",
    "dq_gate_quarantine": "noop",
    "dim_geolocation": "collect",
    "payments_per_order": "noop",
    "fct_order_items": "noop",
    "mart_order_analytics": "noop",
}


def _sf(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    from tillroll.paths import LayerPaths
    from tillroll.plans import pipeline
    from tillroll.plans.queries import all_queries
    from tillroll.session import local_session, scratch_path
    from tillroll.sources.driver_tables import DriverTables
    from tillroll.sources.landing import land_tables

    parts = max(8, int(CPUS) * 2) if CPUS.isdigit() else 16
    spark = local_session(CPUS, shuffle_partitions=parts, app_name="tillroll-bench")
    qs = all_queries()

    def run(name: str, how: str) -> float:
        t0 = time.perf_counter()
        df = qs[name](spark, SF_DIR)
        if how == "collect":
            rows[name] = len(df.collect())
        else:
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    fastest: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, how in HEADLINE.items():
        run(name, how)  # warm-up, not timed
        runs = sorted(run(name, how) for _ in range(REPEAT))
        times[name] = round(runs[len(runs) // 2], 3)
        fastest[name] = round(runs[0], 3)

    # pipeline: one untimed run, then one timed run, each on its own landing
    for timed in (False, True):
        paths = LayerPaths.under(scratch_path(spark, "bench-pipeline"))
        land_tables(DriverTables(spark, SF_DIR).bronze(), paths)
        t0 = time.perf_counter()
        pipeline.run_pipeline(spark, paths)
        if timed:
            times["warehouse_build"] = round(time.perf_counter() - t0, 3)
            fastest["warehouse_build"] = times["warehouse_build"]

    print(json.dumps({
        "metric": "sum_of_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "queries_min": fastest,
        "rows": rows,
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "repeat": REPEAT,
    }))


if __name__ == "__main__":
    main()
