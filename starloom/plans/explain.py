"""Physical-plan report of the build's marts and of headline queries.

    python -m starloom.plans.explain /root/testdata/sf0.01 > PLANS.md

Lands the raw tables and the snapshot (as a build does), then prints, for
the mart DataFrames planned on them: shuffles (Exchange), broadcasts, joins,
and every Parquet scan with its ReadSchema and PushedFilters. The static plan
is shown (AQE re-plans at run time on top of it), once as planned here and
once with size-based broadcasts disabled, which is the shape large inputs get.
"""

from __future__ import annotations

import re
import sys

from starloom.plans import quality_suite
from starloom.plans.build import Build
from starloom.plans.warehouse import Warehouse
from starloom.session import build_session


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(text: str) -> list[str]:
    stages = len(set(re.findall(r"\*\((\d+)\)", text)))
    shuffles = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", text)
    out = [
        f"- shuffles: {len(shuffles)} {shuffles}",
        f"- broadcast exchanges: {text.count('BroadcastExchange')}, reused exchanges: {text.count('ReusedExchange')}, "
        f"sort-merge joins: {text.count('SortMergeJoin')}, broadcast hash joins: {text.count('BroadcastHashJoin')}, "
        f"whole-stage codegen stages: {stages}",
    ]
    for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\].*?(PushedFilters: \[[^\]]*\]).*?(ReadSchema: [^\n]*)", text):
        out.append(f"- scan {m.group(2)[:200]}; {m.group(3)[:220]}")
    return out


def main(sf_dir: str) -> None:
    spark = build_session(master="local[8]", cores=8, app="starloom-explain")
    spark.sparkContext.setLogLevel("ERROR")
    b = Build(spark, sf_dir)
    b.land_raw()
    b.run_snapshot()
    b.build_marts()
    b.build_stream_tables()
    print("# Physical plans\n")
    print(f"Input: `{sf_dir}`. A build has landed the raw tables, the snapshot and the dimensions; the plans")
    print("below are on those tables. The as-of join is planned on landed orders, not on its written result.\n")
    for mode, threshold in [("as planned at this scale", "10485760"), ("at scale (no size-based broadcast)", "-1")]:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        print(f"## {mode}\n")
        frames = dict(b.mart_frames())
        frames["customers_snapshot (second run)"] = b.snapshot_frame()
        wh = Warehouse(spark, sf_dir)
        frames["quality suite (87 tests)"] = quality_suite.results_lazy(b.models())
        frames["int_order_totals (from driver tables)"] = wh.int_order_totals
        frames["stream_daily_metrics (from driver tables)"] = wh.stream_daily_metrics
        for name, df in frames.items():
            print(f"### {name}\n")
            print("\n".join(summarize(plan_text(df))))
            print()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
