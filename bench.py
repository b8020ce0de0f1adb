"""Benchmark: a full warehouse build, an incremental rebuild, the streaming
job, and the headline queries, at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line:
{"metric": "warehouse_build_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("TZ", "UTC")

# Orders from this day on come with the second build (about a quarter of them).
LATER_ORDERS = "2000-01-01 00:00:00"
HEADLINE = ["fact_orders", "fact_order_items", "customers_snapshot", "int_order_totals",
            "stream_daily_metrics", "fact_orders_incremental", "job_log_rollup"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from starloom.session import build_session

    spark = build_session(master=f"local[{cpus}]", cores=cpus, app="starloom-bench")
    spark.sparkContext.setLogLevel("ERROR")

    from starloom.plans.build import Build
    from starloom.plans.catalog import QUERIES
    from starloom.streaming import order_metrics as om

    timings: dict[str, float] = {}
    b = Build(spark, sf_dir, orders_before=LATER_ORDERS)  # the rebuild loads the rest
    timings.update(b.full())
    b.rebuild()  # raw tables again, snapshot pass, dimensions, new orders into the facts, all tests
    timings["incremental_build"] = b.timings["rebuild"]
    timings["incremental_facts_only"] = b.timings["incremental_build"]

    t = time.perf_counter()
    sink = om.run_to_completion(spark, om.file_event_source(spark, sf_dir))
    sink.write.format("noop").mode("overwrite").save()
    timings["stream_window_metrics"] = round(time.perf_counter() - t, 3)

    for name in HEADLINE:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[f"q_{name}"] = round(time.perf_counter() - t, 3)

    total = timings["full_build"] + timings["incremental_build"] + timings["stream_window_metrics"]
    passed = sum(1 for r in b.test_rows if r["status"] == "pass")
    out = {
        "metric": "warehouse_build_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "tests_passed": f"{passed}/{len(b.test_rows)}",
        "build_steps": b.step_timings,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
