"""Window metrics (batch twin of the stream job) and what is built on them.

The window aggregation is shared with the streaming job
(``starloom.streaming.order_metrics``): one-minute tumbling windows, completed
orders counted with conditional aggregates rather than a filter, windows
without completed orders dropped after aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom import fixed as FX
from starloom.functions import date_key, millis_between, money
from starloom.operators.quantile import spread_of

WINDOW = FX.WINDOW
WATERMARK = FX.WATERMARK
COMPLETED = FX.COMPLETED


def window_aggregate(events: DataFrame, rounded: bool = True) -> DataFrame:
    """Per one-minute event-time window: order_count, revenue, avg_basket_size.

    ``status = 'completed'`` is a condition inside the aggregates, not a
    ``where``: in a stream every event (heartbeats, other statuses) must reach
    the watermark, and Catalyst would push a filter below it.
    Money is summed in decimal, so the sum does not depend on the order of
    the rows. Revenue is rounded to cents and the basket size to 4 places, or
    neither with ``rounded=False`` (the SQL form of the job).
    """
    completed = F.col("status") == F.lit(COMPLETED)
    agg = events.groupBy(F.window("event_time", WINDOW)).agg(
        F.count_if(completed).alias("order_count"),
        F.sum(F.when(completed, F.col("order_total").cast(FX.STREAM_MONEY))).alias("_revenue"),
        F.sum(F.when(completed, F.col("item_count").cast("long"))).alias("_items"),
    )
    basket = F.col("_items") / F.col("order_count")
    return agg.where(F.col("order_count") > 0).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("order_count"),
        (F.round("_revenue", FX.REVENUE_PLACES) if rounded else F.col("_revenue")).cast("double").alias("revenue"),
        (F.round(basket, FX.BASKET_PLACES) if rounded else basket).alias("avg_basket_size"),
    )


def window_metrics_batch(events: DataFrame, rounded: bool = True) -> DataFrame:
    """What the stream emits for a replay of ``events``: closed windows only.

    The final watermark (max event time at ms precision minus the delay) is
    an uncorrelated scalar subquery in the plan; no value goes through the
    driver. With no events it is NULL and nothing is emitted.
    """
    final_wm = events.select(
        (F.date_trunc("millisecond", F.max("event_time")) - F.expr(f"interval {WATERMARK}")).alias("wm")
    ).scalar()
    return window_aggregate(events, rounded).where(F.col("window_end") <= final_wm)


def stream_daily_metrics(window_metrics: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Windows rolled up per calendar day, joined to the date dimension.

    Windows are few beside events; the join strategy is left to run-time sizes.
    """
    w = window_metrics.withColumn("_date_key", date_key("window_start"))
    days = dim_date.select("date_key", "date_day", "day_name")
    j = w.join(days, F.col("_date_key") == F.col("date_key"))
    sums = [
        F.count(F.lit(1)).alias("windows"),
        F.sum("order_count").alias("orders"),
        money(F.sum("revenue").cast("decimal(38,9)")).alias("revenue"),
        money(F.avg("avg_basket_size").cast("decimal(38,9)")).alias("avg_basket_size"),
    ]
    if "latency_ms" in window_metrics.columns:  # a sink table: a job measured it
        sums += [F.round(F.avg("latency_ms").cast("decimal(38,9)"), 1).cast("double").alias("avg_latency_ms"),
                 F.max("latency_ms").alias("max_latency_ms")]
    return j.groupBy("date_day", "day_name").agg(*sums)


def spread(values: DataFrame, value: str, by: list[str], prefix: str) -> DataFrame:
    """Count, least, exact median and greatest of ``value`` per group.

    Equal values are counted before they meet (combined map-side), so the
    median's window orders a group's distinct values, not its rows.
    """
    counted = values.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(group))
    lower = F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), F.col("_v")))
    upper = F.min(F.when(F.col("_upto") * 2 > F.col("_all"), F.col("_v")))
    return placed.groupBy(*by).agg(
        F.sum("_n").alias("rows"), F.min("_v").alias(f"{prefix}_min_ms"),
        ((lower + upper) / 2.0).alias(f"{prefix}_median_ms"), F.max("_v").alias(f"{prefix}_max_ms"))


def ship_latency(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Per line: the month it was ordered in and the milliseconds until it shipped."""
    o = orders.select(F.col("o_orderkey").alias("_order"), F.col("o_orderdate").cast("timestamp").alias("_ordered"))
    shipped = F.col("l_shipdate").cast("timestamp")
    return lines.select("l_orderkey", "l_shipdate").join(o, F.col("l_orderkey") == F.col("_order")).select(
        F.date_format("_ordered", "yyyy-MM").alias("order_month"), millis_between(F.col("_ordered"), shipped).alias("latency_ms"))


def latency_detail(window_metrics: DataFrame) -> DataFrame:
    """Per window: end-to-end latency and the engine's emit latency."""
    return window_metrics.select(
        "window_start", "window_end", "order_count",
        F.col("latency_ms"),
        millis_between(F.col("window_end"), F.col("emitted_at")).alias("emit_latency_ms"),
    )


def latency_summary(window_metrics: DataFrame) -> DataFrame:
    """min / median / max of both latencies of a sink, windows and orders (one row)."""
    d = latency_detail(window_metrics)
    total = d.agg(F.count(F.lit(1)).alias("windows"), F.sum("order_count").alias("orders_in_windows"))
    parts = [spread_of(d, v, p).drop("rows") for v, p in (("latency_ms", "latency"), ("emit_latency_ms", "emit"))]
    return total.select("*", *[F.lit(part.first()[f.name]).cast(f.dataType).alias(f.name) for part in parts for f in part.schema.fields])


def first_seen(spark: SparkSession, events: DataFrame, t0: str) -> DataFrame:
    """The first event of each customer and minute from ``t0`` on, and how many there were.

    ``event_time >= :t0`` is a named SQL parameter; the first one is a
    ``min_by`` (combined map-side), ties go to the least event.
    """
    kept = spark.sql("SELECT * FROM {events} WHERE event_time >= :t0",
                     args={"t0": dt.datetime.fromisoformat(t0)}, events=events)
    first = F.min_by(F.struct("event_time", "order_id", "status"), F.struct("event_time", "order_id"))
    return kept.groupBy("customer_id", F.date_trunc("minute", "event_time").alias("minute_start")).agg(
        first.alias("_first"), F.count(F.lit(1)).alias("sightings")).select(
        "customer_id", "minute_start", F.col("_first.event_time").alias("first_seen_at"),
        F.col("_first.order_id").alias("first_order_id"), F.col("_first.status").alias("first_status"), "sightings")
