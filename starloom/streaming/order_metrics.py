"""Structured Streaming: one-minute event-time order metrics.

source (Kafka JSON, or a file directory standing in for it)
  -> parse (malformed events dropped)
  -> watermark 2 s on event_time
  -> tumbling 1-minute window, conditional aggregates (completed orders)
  -> append mode: a window is emitted once, when the watermark passes its end;
     late rows are dropped by the state operator
  -> foreachBatch sink: adds loaded_at / latency_ms and writes the batch to
     ``<sink>/batch_id=<id>`` with overwrite, so a retried batch replaces its
     own output (idempotent), never duplicates it.

The state is one aggregation buffer per open window: the partial aggregate
runs before the shuffle on the window key, so a busy minute costs one partial
row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.functions import iso_millis, millis_between
from starloom.plans.stream_marts import WATERMARK, window_aggregate
from starloom.schemas import ORDER_EVENT
from starloom.session import scratch_path
from starloom.sources.driver_tables import PURCHASE


def parse_json_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> typed order events; text that does not parse is dropped and counted.

    Times are read as text and cast: ISO-8601 with any number of fraction
    digits and with or without a zone (UTC when absent). ``from_json`` in
    PERMISSIVE mode yields NULL fields for malformed input; a row without event
    time cannot be placed in a window. The observed metric ``parsed_events``
    (rows, malformed) tells how many there were.
    """
    times = ("event_time", "produced_at")
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in times else f for f in ORDER_EVENT.fields])
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), as_text).alias("e")).select(
        *[F.col(f"e.{f.name}").try_cast("timestamp").alias(f.name) if f.name in times else F.col(f"e.{f.name}")
          for f in ORDER_EVENT.fields])
    counted = parsed.observe("parsed_events", F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("event_time").isNull()).alias("malformed"))
    return counted.where(F.col("event_time").isNotNull())


def events_to_json(events: DataFrame) -> DataFrame:
    """Keyed JSON records as the producer writes them (key = order id text)."""
    return events.select(
        F.col("order_id").cast("string").alias("key"),
        F.to_json(F.struct(
            "order_id", "customer_id", "order_total", "item_count", "status",
            iso_millis("event_time").alias("event_time"),
            iso_millis("produced_at").alias("produced_at"),
        )).alias("value"),
    )


ENVELOPE = "data string, attributes map<string,string>"
TIME_ATTRIBUTE = "event_time"


def events_to_envelopes(events: DataFrame) -> DataFrame:
    """Messages as a broker with attributes carries them: event time in the attributes, the payload without it."""
    return events.select(
        F.to_json(F.struct("order_id", "customer_id", "order_total", "item_count", "status",
                           iso_millis("produced_at").alias("produced_at"))).alias("data"),
        F.create_map(F.lit(TIME_ATTRIBUTE), iso_millis("event_time"), F.lit("source"), F.lit("orders")).alias("attributes"))


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """Envelopes -> typed order events whose event time is that of the message's attribute.

    A time in the payload does not count. A message without a readable attribute has no place in time
    and is dropped, one whose payload does not parse keeps its time and advances the watermark; ``parsed_events``
    counts both.
    """
    fields = [f for f in ORDER_EVENT.fields if f.name != "event_time"]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "produced_at" else f for f in fields])
    parsed = raw.select(
        F.from_json("data", as_text).alias("e"), F.try_element_at("attributes", F.lit(TIME_ATTRIBUTE)).try_cast("timestamp").alias("event_time"))
    typed = parsed.select(*[
        F.col("event_time") if f.name == "event_time" else
        F.col("e.produced_at").try_cast("timestamp").alias("produced_at") if f.name == "produced_at" else F.col(f"e.{f.name}")
        for f in ORDER_EVENT.fields])
    counted = typed.observe("parsed_events", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_time").isNull()).alias("untimed"),
                            F.count_if(F.col("order_id").isNull()).alias("malformed"))
    return counted.where(F.col("event_time").isNotNull())


def envelope_event_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of envelopes as a stream of order events."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_envelopes(reader.parquet(path))


def windows_to_json(windows: DataFrame) -> DataFrame:
    """Window rows as JSON values (the result topic's format)."""
    return windows.select(
        F.to_json(F.struct(
            iso_millis("window_start").alias("window_start"),
            iso_millis("window_end").alias("window_end"),
            "order_count", "revenue", "avg_basket_size",
            *([iso_millis("emitted_at").alias("emitted_at")] if "emitted_at" in windows.columns else []),
        )).alias("value")
    )


def order_metrics(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """The streaming plan (also valid on a batch DataFrame)."""
    return (
        window_aggregate(events.withWatermark("event_time", watermark))
        .withColumn("emitted_at", F.current_timestamp())
    )


def file_event_source(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The test ``events`` table read as a stream (file source needs a directory)."""
    from starloom.sources.driver_tables import read

    schema = read(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    e = reader.parquet(sf_dir)
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("order_total"),
        F.get_json_object("props", "$.k").cast("int").alias("item_count"),
        F.when(F.col("event_type") == PURCHASE, F.lit("completed")).otherwise(F.col("event_type")).alias("status"),
        ts.alias("event_time"),
        ts.alias("produced_at"),
    )


def kafka_event_source(spark: SparkSession, bootstrap: str, topic: str = "orders") -> DataFrame:
    """Kafka JSON source, earliest offsets. Needs the Kafka connector package."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return parse_json_events(raw)


def json_dir_event_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines in a directory (one event per line) as a stream."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_json_events(reader.load(path))


def sink_batch(sink_path: str):
    """foreachBatch writer: stamp load time, write the batch idempotently."""

    def write(batch: DataFrame, batch_id: int) -> None:
        loaded = batch.withColumn("loaded_at", F.current_timestamp())
        out = loaded.withColumn("latency_ms", millis_between(F.col("window_end"), F.col("loaded_at")))
        out.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    return write


def start(
    spark: SparkSession,
    events: DataFrame,
    sink_path: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> tuple[StreamingQuery, str]:
    """Start the job; returns the query and the sink path."""
    sink_path = sink_path or scratch_path(spark, "stream", "window_metrics")
    checkpoint = checkpoint or scratch_path(spark, "stream", "checkpoint")
    w = order_metrics(events).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(sink_batch(sink_path))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(), sink_path


def run_to_completion(spark: SparkSession, events: DataFrame, timeout_s: int | None = None) -> DataFrame:
    """Replay everything available, close what the watermark allows, return the sink."""
    q, sink = start(spark, events)
    finished = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if timeout_s is not None and not finished:
        q.stop()
        raise TimeoutError("stream did not drain in time")
    if q.exception() is not None:
        raise q.exception()
    return read_sink(spark, sink)


def read_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    """The sink table; empty with the declared schema before the first batch."""
    from starloom.schemas import WINDOW_METRICS
    from starloom.sources import fs

    if not fs.exists(spark, sink_path):
        return spark.createDataFrame([], WINDOW_METRICS)
    return spark.read.schema(WINDOW_METRICS).parquet(sink_path).select(*WINDOW_METRICS.fieldNames())


def first_window_landed(spark: SparkSession, sink_path: str) -> bool:
    """Warm-up gate: has any window reached the sink yet? (a LIMIT 1 probe)"""
    return not read_sink(spark, sink_path).isEmpty()


def start_kafka(
    spark: SparkSession,
    events: DataFrame,
    bootstrap: str,
    topic: str = "order_metrics",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """The same job writing window rows as JSON to a Kafka topic (needs the
    Kafka connector package on the cluster)."""
    checkpoint = checkpoint or scratch_path(spark, "stream", "checkpoint-kafka")
    return (
        windows_to_json(order_metrics(events))
        .writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_events_kafka(events: DataFrame, bootstrap: str, topic: str = "orders") -> None:
    """Publish order events as keyed JSON records (batch write to Kafka)."""
    (
        events_to_json(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .save()
    )


def reset_sink(spark: SparkSession, sink_path: str) -> None:
    """Empty the sink table (the schema stays); pair with a fresh checkpoint."""
    from starloom.schemas import WINDOW_METRICS

    from starloom.sources import fs

    spark.createDataFrame([], WINDOW_METRICS).write.mode("overwrite").parquet(f"{sink_path}/batch_id=-1")
    for name in fs.children(spark, sink_path):
        if name.startswith("batch_id=") and name != "batch_id=-1":
            fs.delete(spark, f"{sink_path}/{name}")


def run_summary(sink: DataFrame) -> dict:
    """Windows, orders in windows and min / median / max of the measured
    latencies (load and emit), from the sink table: one aggregated row."""
    from starloom.plans.stream_marts import latency_summary

    r = latency_summary(sink).first()
    return {k: (float(v) if isinstance(v, float) else v) for k, v in r.asDict().items()}


def main(argv: list[str] | None = None) -> None:
    """``python -m starloom.streaming.order_metrics <events dir> [--kafka host:port]``:
    replay the events through the job (file source, or Kafka when given), drain
    with availableNow, print the run summary as JSON."""
    import argparse
    import json

    from starloom.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("input", help="directory holding events.parquet (file source)")
    ap.add_argument("--kafka", help="bootstrap servers; read topic 'orders' instead of files")
    ap.add_argument("--timeout", type=int, default=3600)
    a = ap.parse_args(argv)
    spark = build_session(app="starloom-stream")
    events = kafka_event_source(spark, a.kafka) if a.kafka else file_event_source(spark, a.input)
    sink = run_to_completion(spark, events, a.timeout)
    print(json.dumps(run_summary(sink), default=str))


if __name__ == "__main__":
    main()
