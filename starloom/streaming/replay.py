"""Replays: a table of events fed to a streaming job in arrival order, one slice after the other.

Each slice of arrival time is one run of the job with the trigger
``availableNow`` on the same checkpoint: its rows come in one go, then the
windows that the watermark has passed are emitted. So the watermark that holds
for a slice is that of all slices before it, a row is late if its window had
closed by then, and the clocks of a slice (when its results are emitted and
loaded) are parameters: a replay gives the same rows, stamps and latencies
each time, and SQL can say which.

The slices are written once by Spark, partitioned by their number; the driver
only moves their directories into the watched folder one by one. Their number
is the replay's time span over ``SLICE_DAYS``, not a count of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.functions import millis_between
from starloom.plans.stream_marts import WATERMARK, window_aggregate
from starloom.schemas import WINDOW_METRICS
from starloom.session import scratch_path
from starloom.sources import fs

#: First day of the replayed span and days of a slice.
REPLAY_START, SLICE_DAYS = "2024-01-01", 7
#: Seconds from a slice's end until its windows are emitted, and until they are loaded.
EMIT_AFTER, LOAD_AFTER = 2.25, 3.5


def slice_of(arrival: Column) -> Column:
    """The number of the slice in which a row arrives; what arrives before the span comes with slice 0."""
    days = F.date_diff(arrival.cast("date"), F.lit(REPLAY_START).cast("date"))
    return F.greatest(F.lit(0), F.floor(days / SLICE_DAYS)).cast("int")


def slice_clock(number: int, after: float) -> dt.datetime:
    """``after`` seconds behind the end of a slice."""
    return dt.datetime.fromisoformat(REPLAY_START) + dt.timedelta(days=SLICE_DAYS * (number + 1), seconds=after)


def replay(rows: DataFrame, run: Callable[[DataFrame, int], StreamingQuery], slice_col: str = "slice") -> None:
    """Feed ``rows`` (with their slice number) to a job: ``run(stream, number)`` starts it for one slice.

    The job must use one checkpoint for all slices and the trigger availableNow.
    """
    spark = rows.sparkSession
    staged, watched = scratch_path(spark, "replay", "staged"), scratch_path(spark, "replay", "watched")
    rows.write.partitionBy(slice_col).parquet(staged)
    schema = T.StructType([f for f in rows.schema.fields if f.name != slice_col])
    names = sorted((int(n.split("=")[1]), n) for n in fs.children(spark, staged) if n.startswith(f"{slice_col}="))
    for number, name in names:
        fs.move(spark, f"{staged}/{name}", f"{watched}/slice-{number:06d}")
        q = run(spark.readStream.schema(schema).parquet(f"{watched}/*"), number)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def clocked_sink(path: str, emitted_at: dt.datetime, loaded_at: dt.datetime):
    """foreachBatch writer whose clocks are given: both stamps and latencies follow from them. A retried batch replaces its output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("emitted_at", F.lit(emitted_at)).withColumn("loaded_at", F.lit(loaded_at))
        out = stamped.withColumn("latency_ms", millis_between(F.col("window_end"), F.col("loaded_at")))
        out.select(*WINDOW_METRICS.fieldNames()).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def windows_of_replay(events: DataFrame, sources: list[Column] | None = None) -> DataFrame:
    """The sink table of the one-minute job after a replay of ``events`` (order events with a column ``slice``).

    ``sources``: conditions that split the events into as many streams, each with a watermark of its own;
    the job then takes the greatest of them, so a source that is idle or behind holds nothing up, and what
    it brings for closed windows is late. The rule holds for this job's session only.
    """
    spark = events.sparkSession
    sink, checkpoint = scratch_path(spark, "replay", "windows"), scratch_path(spark, "replay", "checkpoint")
    events = events.select("order_id", "customer_id", "order_total", "item_count", "status", "event_time", "slice")
    if sources:
        session = spark.newSession()
        for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
            if spark.conf.get(k, None) is not None:
                session.conf.set(k, spark.conf.get(k))
        session.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
        staged = scratch_path(spark, "replay", "events")
        events.withColumn("source", sum(F.when(c, i).otherwise(0) for i, c in enumerate(sources))).write.parquet(staged)
        events = session.read.parquet(staged)

    def job(stream: DataFrame) -> DataFrame:
        if not sources:
            return window_aggregate(stream.withWatermark("event_time", WATERMARK))
        marked = [stream.where(F.col("source") == i).withWatermark("event_time", WATERMARK) for i in range(len(sources))]
        union = marked[0]
        for other in marked[1:]:
            union = union.unionByName(other)
        return window_aggregate(union)

    def run(stream: DataFrame, number: int) -> StreamingQuery:
        writer = clocked_sink(sink, slice_clock(number, EMIT_AFTER), slice_clock(number, LOAD_AFTER))
        return (job(stream).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .foreachBatch(writer).trigger(availableNow=True).start())

    replay(events, run)
    return read_table(spark, sink, WINDOW_METRICS)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a batch sink has written; empty before its first batch."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


# what is replayed --------------------------------------------------------------
def with_late_arrivals(events: DataFrame) -> DataFrame:
    """Every eleventh event arrives two days late, every seventh of the others ten minutes."""
    late = F.when(F.col("order_id") % 11 == 4, F.expr("interval 2 days")).when(
        F.col("order_id") % 7 == 2, F.expr("interval 10 minutes")).otherwise(F.expr("interval 0 seconds"))
    return events.withColumn("slice", slice_of(F.col("event_time") + late))


def with_silent_orders(events: DataFrame, orders_end: str) -> DataFrame:
    """Orders stop at ``orders_end``; from all other events only heartbeats are left, which go on."""
    completed = F.col("status") == F.lit("completed")
    kept = events.where(~completed | (F.col("event_time") < F.to_timestamp(F.lit(orders_end))))
    beat = kept.withColumn("status", F.when(completed, F.col("status")).otherwise(F.lit("tail")))
    for c in ("order_total", "item_count"):
        beat = beat.withColumn(c, F.when(completed, F.col(c)).otherwise(F.lit(0).cast(kept.schema[c].dataType)))
    return beat.withColumn("slice", slice_of(F.col("event_time")))


def with_slow_source(events: DataFrame) -> DataFrame:
    """Events of odd customers arrive six days after those of even ones."""
    behind = F.when(F.col("customer_id") % 2 == 1, F.expr("interval 6 days")).otherwise(F.expr("interval 0 seconds"))
    return events.withColumn("slice", slice_of(F.col("event_time") + behind))


# first sightings ---------------------------------------------------------------
def sightings(windows: DataFrame, polls: int = 3) -> DataFrame:
    """What a reader of the sink sees that asks once a slice: each window when it is loaded and at the next ``polls`` - 1 times."""
    every = F.make_dt_interval(F.lit(SLICE_DAYS) * F.col("later"))
    seen = windows.withColumn("later", F.explode(F.sequence(F.lit(0), F.lit(polls - 1)))).withColumn("loaded_at", F.col("loaded_at") + every)
    # The slice whose poll this is ends just before it.
    return seen.drop("later", "latency_ms").withColumn("slice", slice_of(F.col("loaded_at") - F.make_dt_interval(F.lit(SLICE_DAYS))))


def first_sightings(seen: DataFrame, t0: str, polls: int = 3) -> DataFrame:
    """The final table: the first sighting of each window with orders that ends after ``t0``, by window start.

    A window's later sightings are dropped by state that is evicted once the watermark on ``loaded_at`` has
    passed the polls in which it can come again. Each micro-batch replaces its own output.
    """
    spark = seen.sparkSession
    sink, checkpoint = scratch_path(spark, "replay", "final"), scratch_path(spark, "replay", "checkpoint")
    wanted = (F.col("order_count") > 0) & (F.col("window_end") > F.to_timestamp(F.lit(t0)))

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.where(wanted).withColumn("latency_ms", millis_between(F.col("window_end"), F.col("loaded_at")))
        out.select(*WINDOW_METRICS.fieldNames()).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    def run(stream: DataFrame, number: int) -> StreamingQuery:
        once = stream.withWatermark("loaded_at", f"{polls * SLICE_DAYS} days").dropDuplicatesWithinWatermark(["window_start"])
        return (once.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .foreachBatch(write).trigger(availableNow=True).start())

    replay(seen, run)
    return read_table(spark, sink, WINDOW_METRICS).orderBy("window_start")
