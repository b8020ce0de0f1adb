"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` (whole tables) or data Spark
derives from them. Quality queries build a persisted warehouse first (tables
written below the scratch root, as a build does) and test those tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import quality_suite as QS
from starloom.plans import reports
from starloom.plans.warehouse import FIXED_LOAD_STAMP, Warehouse
from starloom.session import app_key, scratch_path
from starloom.sources import fs

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Reproducible parameters of the report queries.
CHECK_INVOCATION = "check"
LOGGED_INVOCATIONS = ("check-1", "check-2")
FRESHNESS_NOW = "2026-01-02 02:00:00"
EVENTS_LIMIT = 0  # 0 = all events
FIRST_EVENTS = 500
JOBS_SINCE = "2024-01-10 00:00:00"
ONE_INVOCATION = "inv-3"
# Replays: when the orders stop, and from where on the final table has windows.
ORDERS_END = "2024-01-20 00:00:00"
FINAL_T0 = "2024-01-08 00:00:00"


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _model(attr: str, persist: bool = False) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Warehouse(spark, sf_dir, persist=persist), attr)
    run.__name__ = attr
    return run


for _attr in [
    "raw_customers", "raw_customer_updates", "raw_products", "raw_orders", "raw_order_items",
    "stg_customers", "stg_products", "stg_orders", "stg_order_items", "int_order_totals",
    "customers_snapshot", "dim_customer", "dim_product", "dim_date", "dim_date_config",
    "fact_orders", "fact_order_items", "fact_orders_incremental", "fact_order_items_incremental",
    "customers_snapshot_published", "fact_orders_published", "fact_order_items_published",
    "dim_customer_restricted", "distinct_people", "distinct_people_by_month", "pii_inventory",
    "window_metrics", "window_metrics_unrounded", "stream_daily_metrics", "latency_detail", "latency_summary", "window_first_seen",
]:
    QUERIES[_attr] = _model(_attr)


# quality -------------------------------------------------------------------
_BUILT: dict[tuple, Warehouse] = {}


def built_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A persisted warehouse per application, input location and state of its files.

    The quality queries all test the same tables, so these are written once per
    application and every test reads them. Files that are added, replaced or rewritten
    make another state (names, sizes and times of all input files), and new tables.
    """
    k = (app_key(spark), sf_dir.rstrip("/"), fs.state(spark, sf_dir))
    if k not in _BUILT:
        _BUILT[k] = Warehouse(spark, sf_dir, persist=True)
    return _BUILT[k]


def _dq(kind: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = built_warehouse(spark, sf_dir)
        return QS.results_lazy(wh.models(), QS.checks_of(kind), with_singular=False)
    run.__name__ = f"dq_{kind}"
    return run


for _kind in ["unique", "not_null", "accepted_values", "relationships"]:
    QUERIES[f"dq_{_kind}"] = _dq(_kind)


def _singular(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = built_warehouse(spark, sf_dir)
        return QS.singular_offenders(wh.models())[name][1]
    return run


QUERIES["dq_no_negative"] = _singular("assert_no_negative_quantities")
QUERIES["dq_totals_reconcile"] = _singular("assert_order_totals_reconcile")
QUERIES["dq_scd2_overlap"] = _singular("assert_scd2_versions_do_not_overlap")
QUERIES["dq_no_raw_pii"] = _singular("assert_analyst_views_have_no_raw_pii")
QUERIES["dq_one_current"] = _singular("assert_one_current_version_per_customer")


@query("dq_results")
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QS.results_lazy(built_warehouse(spark, sf_dir).models())


@query("dq_summary")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = QS.run_results(spark, dq_results(spark, sf_dir))
    return QS.dq_summary(spark, res, FIXED_LOAD_STAMP, CHECK_INVOCATION)


@query("dq_failures")
def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = QS.run_results(spark, dq_results(spark, sf_dir))
    return QS.dq_failures(res, FIXED_LOAD_STAMP, CHECK_INVOCATION)


@query("quality_log")
def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after two builds appended their results to it."""
    path = scratch_path(spark, "quality-log")
    tested = scratch_path(spark, "quality-results")
    dq_results(spark, sf_dir).write.parquet(tested)
    for invocation in LOGGED_INVOCATIONS:
        QS.append_log(QS.run_results(spark, spark.read.parquet(tested)), path, FIXED_LOAD_STAMP, invocation)
    return QS.read_log(spark, path)


# reports -------------------------------------------------------------------
@query("row_counts")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, sf_dir)
    return reports.row_counts({
        "customers": wh.raw_customers, "customer_updates": wh.raw_customer_updates,
        "products": wh.raw_products, "orders": wh.raw_orders, "order_items": wh.raw_order_items,
        "window_metrics": wh.window_metrics,
    })


@query("source_freshness")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, sf_dir)
    return reports.source_freshness({
        "customers": ("raw", wh.raw_customers, "_loaded_at"),
        "customer_updates": ("raw", wh.raw_customer_updates, "_loaded_at"),
        "products": ("raw", wh.raw_products, "_loaded_at"),
        "orders": ("raw", wh.raw_orders, "_loaded_at"),
        "order_items": ("raw", wh.raw_order_items, "_loaded_at"),
        "window_metrics": ("stream", wh.window_metrics, "window_end"),
    }, FRESHNESS_NOW)


@query("contract_check")
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = built_warehouse(spark, sf_dir)  # written tables: counting them reads footers only
    return reports.contract_check(spark, {
        "dim_date": wh.dim_date, "dim_product": wh.dim_product, "dim_customer": wh.dim_customer,
        "fact_orders": wh.fact_orders, "fact_order_items": wh.fact_order_items,
    })


@query("export_replay")
def export_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.export_replay(Warehouse(spark, sf_dir).fact_orders)


@query("order_events_json")
def order_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.streaming.order_metrics import events_to_json

    ev = reports.first_n(Warehouse(spark, sf_dir).order_events, EVENTS_LIMIT, ["event_time", "order_id"])
    return events_to_json(ev)


@query("window_metrics_json")
def window_metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starloom.streaming.order_metrics import windows_to_json

    return windows_to_json(Warehouse(spark, sf_dir).window_metrics)


@query("order_events_first_n")
def order_events_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The producer's limit: the first events in event time."""
    return reports.first_n(Warehouse(spark, sf_dir).order_events, FIRST_EVENTS, ["event_time", "order_id"])


@query("job_log_rollup")
def job_log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.job_log_rollup(reports.job_log(spark, sf_dir))


@query("job_log_rollup_one")
def job_log_rollup_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invocation's jobs from a time horizon on."""
    return reports.job_log_rollup(reports.job_log(spark, sf_dir), ONE_INVOCATION, dt.datetime.fromisoformat(JOBS_SINCE))


@query("stream_window_metrics")
def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Structured Streaming job over the events file, drained with availableNow."""
    from starloom.streaming import order_metrics as om

    sink = om.run_to_completion(spark, om.file_event_source(spark, sf_dir))
    return sink.select("window_start", "window_end", "order_count", "revenue", "avg_basket_size")


@query("stream_json_metrics")
def stream_json_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job from JSON: events written as text by Spark, read and parsed as a stream."""
    from starloom.streaming import order_metrics as om

    path = scratch_path(spark, "stream", "events-json")
    om.events_to_json(Warehouse(spark, sf_dir).order_events).select("value").write.text(path)
    sink = om.run_to_completion(spark, om.json_dir_event_source(spark, path))
    return sink.select("window_start", "window_end", "order_count", "revenue", "avg_basket_size")


# replays: streams fed slice by slice, so that the watermark of each slice is known ------------
def _replayed(name: str, prepare_events: Callable[[DataFrame], DataFrame], columns: list[str], sources: bool = False) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from starloom.streaming import replay

        events = prepare_events(Warehouse(spark, sf_dir).order_events)
        by_customer = [F.col("customer_id") % 2 == 0, F.col("customer_id") % 2 == 1] if sources else None
        return replay.windows_of_replay(events, by_customer).select(*columns)
    run.__name__ = name
    QUERIES[name] = run


def _late(events: DataFrame) -> DataFrame:
    from starloom.streaming.replay import with_late_arrivals

    return with_late_arrivals(events)


def _silent(events: DataFrame) -> DataFrame:
    from starloom.streaming.replay import with_silent_orders

    return with_silent_orders(events, ORDERS_END)


def _slow(events: DataFrame) -> DataFrame:
    from starloom.streaming.replay import with_slow_source

    return with_slow_source(events)


WINDOW_COLUMNS = ["window_start", "window_end", "order_count", "revenue", "avg_basket_size"]
_replayed("stream_late_data", _late, WINDOW_COLUMNS)
_replayed("stream_heartbeat", _silent, WINDOW_COLUMNS)
_replayed("stream_two_sources", _slow, WINDOW_COLUMNS, sources=True)


@query("stream_window_latency")
def stream_window_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emit and load stamp of each window, and both latencies, by the clocks given to the sink."""
    from starloom.plans.stream_marts import latency_detail
    from starloom.streaming import replay

    sink = replay.windows_of_replay(_late(Warehouse(spark, sf_dir).order_events))
    return latency_detail(sink).join(sink.select("window_start", "emitted_at", "loaded_at"), "window_start")


@query("stream_final_windows")
def stream_final_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sighting per window in the final table: windows with orders behind the horizon, by window start."""
    from starloom.streaming import replay

    sink = replay.windows_of_replay(_late(Warehouse(spark, sf_dir).order_events))
    return replay.first_sightings(replay.sightings(sink), FINAL_T0)


@query("stream_attribute_time")
def stream_attribute_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from message envelopes: event time from the attributes, the payload parsed apart."""
    from starloom.streaming import order_metrics as om

    path = scratch_path(spark, "stream", "envelopes")
    om.events_to_envelopes(Warehouse(spark, sf_dir).order_events).write.parquet(path)
    sink = om.run_to_completion(spark, om.envelope_event_source(spark, path))
    return sink.select(*WINDOW_COLUMNS)
