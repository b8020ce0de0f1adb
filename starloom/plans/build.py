"""A full warehouse build, an incremental load and a second build, as Spark jobs.

Dependency order: land raw tables (one load stamp per run) -> snapshot (seed
run without the update batch, then with it) -> dimensions -> enriched order
headers -> facts (contract-checked before each write) -> tests -> quality log
(append). Independent chains run concurrently, and the tests of the
non-fact models run while the facts build.

Every table is written once below ``root`` and read back by its consumers.
The enriched order headers are written once for both facts, which join them
by plain shuffle joins that AQE can split. Facts are partitioned by order
month, so an incremental run touches only the months it changes. Facts and
the customer history are published by version: a reader beside a load sees the
table before or after it.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import history, publish
from starloom.operators.incremental import newer_than
from starloom.operators.scd2 import snapshot
from starloom.plans import marts, quality_suite, reports, staging
from starloom.plans.warehouse import Warehouse
from starloom.session import prepare, scratch_root
from starloom.sources import driver_tables as raw

MONTH = "order_month"


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.parquet(path)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("ordered_at", "yyyy-MM"))


class Build:
    """One build run writing below ``root`` (defaults to the scratch root)."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None, threads: int = 4,
                 orders_before: str | None = None):
        self.spark = prepare(spark)
        self.threads = threads
        self.sf_dir = sf_dir
        # Orders that the first landing has, with their lines: those placed before this time (None: all).
        self.orders_before = orders_before
        self.root = (root or f"{scratch_root(spark)}/warehouse-{uuid.uuid4().hex[:8]}").rstrip("/")
        self.timings: dict[str, float] = {}
        self.step_timings: dict[str, float] = {}
        self.tables: dict[str, DataFrame] = {}
        self.stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    def _timed(self, name: str, fn):
        t = time.perf_counter()
        out = fn()
        self.timings[name] = round(time.perf_counter() - t, 3)
        return out

    def _parallel(self, jobs: dict) -> None:
        """Run independent table writes concurrently (name -> zero-arg function)."""
        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            futures = {name: pool.submit(fn) for name, fn in jobs.items()}
            for name, fut in futures.items():
                self.tables[name] = fut.result()

    def _land(self, name: str) -> DataFrame:
        """Land one raw table with this run's load stamp."""
        def source(table: str) -> DataFrame:
            df = raw.RAW_BUILDERS[table](self.spark, self.sf_dir, self.stamp)
            if table == "orders" and self.orders_before:
                df = df.where(F.col("ordered_at") < F.to_timestamp(F.lit(self.orders_before)))
            return df

        df = source(name)
        if name == "order_items" and self.orders_before:  # the lines come with their orders
            df = df.join(source("orders").select("order_id"), "order_id", "left_semi").select(*df.columns)
        return _write(df, f"{self.root}/raw/{name}")

    def land_raw(self) -> None:
        self._parallel({f"raw_{name}": (lambda name=name: self._land(name)) for name in raw.RAW_BUILDERS})

    @property
    def history_path(self) -> str:
        return f"{self.root}/snapshots/customers_snapshot"

    def fact_path(self, fact: str) -> str:
        return f"{self.root}/marts/{fact}"

    def read_fact(self, fact: str) -> DataFrame:
        """The fact as last published."""
        return publish.read(self.spark, self.fact_path(fact)).drop(MONTH)

    def _snapshot_run(self, current: DataFrame) -> DataFrame:
        history.run_snapshot(self.spark, current, self.history_path, "customer_id")
        return history.read_history(self.spark, self.history_path)

    def _snapshot_seed(self) -> DataFrame:
        """First snapshot run: the initial customers only (no update batch)."""
        return self._snapshot_run(staging.stg_customers(self.tables["raw_customers"], None, include_updates=False))

    def _customers(self) -> DataFrame:
        t = self.tables
        return staging.stg_customers(t["raw_customers"], t["raw_customer_updates"], include_updates=True)

    def snapshot_frame(self) -> DataFrame:
        """The second run as one DataFrame: customers with the update batch, against the seed history."""
        return snapshot(self._customers(), self.tables["customers_snapshot_v1"], "customer_id")

    def _snapshot_current(self) -> DataFrame:
        return self._snapshot_run(self._customers())

    def run_snapshot(self) -> None:
        t = self.tables
        t["customers_snapshot_v1"] = self._snapshot_seed()
        t["customers_snapshot"] = self._snapshot_current()

    def _dim_date(self) -> DataFrame:
        covers = [self.tables["raw_orders"].select("ordered_at"),
                  raw.order_events(self.spark, self.sf_dir).select("event_time")]
        dim = marts.dim_date(self.spark, covers=covers)
        return _write(reports.enforce_contract(dim, "dim_date"), f"{self.root}/marts/dim_date")

    def _dim_product(self) -> DataFrame:
        stg_products = staging.stg_products(self.tables["raw_products"])
        return _write(reports.enforce_contract(marts.dim_product(stg_products), "dim_product"),
                      f"{self.root}/marts/dim_product")

    def _dim_customer(self) -> DataFrame:
        dim = marts.dim_customer(self.tables["customers_snapshot"])
        return _write(reports.enforce_contract(dim, "dim_customer"), f"{self.root}/marts/dim_customer")

    def build_marts(self) -> None:
        self._parallel({"dim_date": self._dim_date, "dim_product": self._dim_product,
                        "dim_customer": self._dim_customer})
        self.build_facts()

    def build_facts(self) -> None:
        t = self.tables
        stg_orders = staging.stg_orders(t["raw_orders"])
        stg_items = staging.stg_order_items(t["raw_order_items"])
        m = f"{self.root}/marts"
        # order headers with their customer version: written once, read by both facts
        enriched = _write(marts.orders_with_customer(stg_orders, t["dim_customer"]), f"{m}/orders_with_customer")
        t["orders_with_customer"] = enriched

        def built(fact: str, df: DataFrame) -> DataFrame:
            publish.create(self.spark, _with_month(reports.enforce_contract(df, fact)), self.fact_path(fact), MONTH)
            return self.read_fact(fact)

        self._parallel({
            "fact_orders": lambda: built("fact_orders", marts.fact_orders(enriched, marts.totals_for(stg_items))),
            "fact_order_items": lambda: built("fact_order_items", marts.fact_order_items(stg_items, enriched, t["dim_product"])),
        })

    def mart_frames(self) -> dict[str, DataFrame]:
        """The mart DataFrames as a build plans them on the landed tables (lazy)."""
        t = self.tables
        stg_orders = staging.stg_orders(t["raw_orders"])
        stg_items = staging.stg_order_items(t["raw_order_items"])
        dim_customer = t.get("dim_customer")
        if dim_customer is None:
            dim_customer = marts.dim_customer(t["customers_snapshot"])
        dim_product = t.get("dim_product")
        if dim_product is None:
            dim_product = marts.dim_product(staging.stg_products(t["raw_products"]))
        placed = marts.orders_with_customer(stg_orders, dim_customer)
        enriched = t.get("orders_with_customer", placed)
        return {
            "dim_customer": marts.dim_customer(t["customers_snapshot"]),
            "orders_with_customer (as-of join)": placed,
            "fact_orders": marts.fact_orders(enriched, marts.totals_for(stg_items)),
            "fact_order_items": marts.fact_order_items(stg_items, enriched, dim_product),
        }

    def _window_metrics(self) -> DataFrame:
        return _write(Warehouse(self.spark, self.sf_dir).window_metrics, f"{self.root}/stream/window_metrics")

    def build_stream_tables(self) -> None:
        self._parallel({"window_metrics": self._window_metrics, "replay_orders": self._export_replay})

    def _export_replay(self) -> DataFrame:
        path = f"{self.root}/stream/replay_orders"
        reports.write_replay(reports.export_replay(self.tables["fact_orders"]), path)
        return self.spark.read.parquet(path)

    def models(self) -> dict[str, DataFrame]:
        t = self.tables
        from starloom.plans.governance import dim_customer_restricted
        from starloom.plans.intermediate import int_order_totals
        from starloom.plans.stream_marts import stream_daily_metrics

        stg_items = staging.stg_order_items(t["raw_order_items"])
        return {
            "raw_customers": t["raw_customers"], "raw_products": t["raw_products"], "raw_orders": t["raw_orders"],
            "raw_order_items": t["raw_order_items"],
            "stg_customers": staging.stg_customers(t["raw_customers"], t["raw_customer_updates"]),
            "stg_products": staging.stg_products(t["raw_products"]),
            "stg_orders": staging.stg_orders(t["raw_orders"]),
            "stg_order_items": stg_items,
            "int_order_totals": int_order_totals(stg_items),
            "dim_date": t["dim_date"], "dim_product": t["dim_product"], "dim_customer": t["dim_customer"],
            **({"fact_orders": t["fact_orders"], "fact_order_items": t["fact_order_items"]}
               if "fact_order_items" in t else {}),
            "dim_customer_restricted": dim_customer_restricted(t["dim_customer"]),
            "stream_daily_metrics": stream_daily_metrics(t["window_metrics"], t["dim_date"]),
        }

    def run_tests(self) -> list:
        # one row per test (87): bounded by the suite, not the data
        return quality_suite.results(self.models()).collect()

    def _run_test_split(self, facts_built: bool) -> list:
        """Tests of the models that exist: before the facts, every check whose
        models are not facts; after them, the fact checks and singular tests."""
        from starloom.operators.quality import evaluate

        facts = {"fact_orders", "fact_order_items"}
        touches = lambda c: c.model in facts or c.to_model in facts
        models = self.models()
        if not facts_built:
            checks = [c for c in quality_suite.CHECKS if not touches(c)]
            return evaluate(models, checks)
        checks = [c for c in quality_suite.CHECKS if touches(c)]
        return evaluate(models, checks, quality_suite.singular_offenders(models))

    def log_quality(self, rows: list, seconds: float) -> None:
        from starloom.operators.quality import results_frame

        res = quality_suite.run_results(self.spark, results_frame(self.spark, [tuple(r) for r in rows]))
        built = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        inv = uuid.uuid4().hex
        quality_suite.append_log(res, f"{self.root}/governance", built, inv, build_seconds=seconds)

    def _chains(self, chains: list) -> None:
        """Run independent chains of steps concurrently; each step stores its table."""
        def run(chain):
            for name, fn in chain:
                t = time.perf_counter()
                self.tables[name] = fn()
                self.step_timings[name] = round(time.perf_counter() - t, 3)

        with ThreadPoolExecutor(max_workers=max(1, len(chains))) as pool:
            for f in [pool.submit(run, c) for c in chains]:
                f.result()

    def full(self) -> dict:
        """The build as a dependency graph: independent chains run concurrently
        (as the warehouse runs independent nodes on several threads)."""
        t0 = time.perf_counter()

        self._timed("raw_snapshot_dims", lambda: (
            self._chains([
                [("raw_customers", lambda: self._land("customers")),
                 ("customers_snapshot_v1", self._snapshot_seed)],
                [("raw_customer_updates", lambda: self._land("customer_updates"))],
                [("raw_order_items", lambda: self._land("order_items"))],
                [("raw_orders", lambda: self._land("orders")),
                 ("raw_products", lambda: self._land("products")),
                 ("dim_product", self._dim_product),
                 ("dim_date", self._dim_date)],
                [("window_metrics", self._window_metrics)],
            ]),
            self._chains([[("customers_snapshot", self._snapshot_current), ("dim_customer", self._dim_customer)]]),
        ))
        rows: list = []

        def tests(facts_built: bool):
            rows.extend(self._run_test_split(facts_built))
            return None

        # the tests of everything but the facts run while the facts build
        self._timed("facts_and_early_tests", lambda: self._chains([
            [("_facts", lambda: self.build_facts())],
            [("_tests_early", lambda: tests(False))],
        ]))
        self._timed("fact_tests_and_replay", lambda: self._chains([
            [("_tests_facts", lambda: tests(True))],
            [("replay_orders", self._export_replay)],
        ]))
        order = {c.name: i for i, c in enumerate(quality_suite.CHECKS)}
        order.update({n: len(order) + i for i, n in enumerate(quality_suite.SINGULAR)})
        rows.sort(key=lambda r: order[r[0]])
        self._timed("quality_log", lambda: self.log_quality(rows, time.perf_counter() - t0))
        self.timings["full_build"] = round(time.perf_counter() - t0, 3)
        self.test_rows = [dict(zip(("test_name", "model", "column_name", "test_type", "severity", "failures",
                                    "status"), r)) for r in rows]
        return self.timings

    def _increment(self, fact: str, stg_orders: DataFrame, stg_items: DataFrame) -> dict:
        t = self.tables
        path = self.fact_path(fact)
        mark = publish.high_water(self.spark, path, "ordered_at")
        fresh = newer_than(stg_orders, "ordered_at", mark)
        if fresh.isEmpty():  # nothing newer than the table: a LIMIT 1 probe, no rewrite
            return {"mode": "noop", "touched_partitions": 0}
        enriched = marts.orders_with_customer(fresh, t["dim_customer"])
        if fact == "fact_orders":
            df, key = marts.fact_orders(enriched, marts.totals_for(stg_items, fresh)), "order_id"
        else:
            items = stg_items.join(fresh.select("order_id"), "order_id", "left_semi")
            df, key = marts.fact_order_items(items, enriched, t["dim_product"]), "order_item_id"
        return publish.delete_insert(self.spark, _with_month(reports.enforce_contract(df, fact)), path, key)

    def incremental(self, new_orders: DataFrame | None = None) -> dict:
        """Re-run the facts incrementally: rows newer than each table's high-water
        mark, delete+insert on the unique key, only touched month partitions
        rewritten. The two facts are independent and run concurrently."""
        t0 = time.perf_counter()
        t = self.tables
        stg_orders = new_orders if new_orders is not None else staging.stg_orders(t["raw_orders"])
        stg_items = staging.stg_order_items(t["raw_order_items"])
        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = {f: pool.submit(self._increment, f, stg_orders, stg_items) for f in ("fact_orders", "fact_order_items")}
            out = {f: fut.result() for f, fut in futures.items()}
        self.timings["incremental_build"] = round(time.perf_counter() - t0, 3)
        return out

    def rebuild(self) -> dict:
        """A second build, as the warehouse's non-full-refresh build: raw tables
        landed again (all orders now), a snapshot pass (no change when no clock
        moved), dimensions rebuilt, facts loaded incrementally, every test run
        again."""
        t0 = time.perf_counter()
        t = self.tables
        self.orders_before = None
        self.stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        self.land_raw()
        t["customers_snapshot"] = self._snapshot_current()
        self._parallel({"dim_date": self._dim_date, "dim_product": self._dim_product,
                        "dim_customer": self._dim_customer})
        self.incremental()
        for fact in ("fact_orders", "fact_order_items"):  # the version that the load published
            t[fact] = self.read_fact(fact)
        self.rebuild_test_rows = self.run_tests()
        self.timings["rebuild"] = round(time.perf_counter() - t0, 3)
        return self.timings


def main(argv: list[str] | None = None) -> None:
    """``python -m starloom.plans.build <input dir> [<warehouse root>]``: a full
    build, then an incremental run; prints the timings and test tally as JSON."""
    import json
    import sys

    from starloom.session import build_session

    args = sys.argv[1:] if argv is None else argv
    spark = build_session(app="starloom-build")
    b = Build(spark, args[0], args[1] if len(args) > 1 else None)
    timings = b.full()
    b.incremental()
    passed = sum(1 for r in b.test_rows if r["status"] == "pass")
    print(json.dumps({"root": b.root, "timings": b.timings, "tests": f"{passed}/{len(b.test_rows)}"}))


if __name__ == "__main__":
    main()
