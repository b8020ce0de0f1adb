"""Operational reports: row counts, freshness, contracts, replay export,
event/result JSON, and the job-log rollup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import fixed as FX
from starloom.operators.incremental import SchemaDrift, check_schema
from starloom.schemas import CONTRACTS
from starloom.sources.driver_tables import read


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``count(*)`` per table, as one union of global aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Freshness thresholds: (warn hours, error hours or None).
FRESHNESS = {"raw": FX.RAW_FRESHNESS_HOURS, "stream": FX.STREAM_FRESHNESS_HOURS}


def source_freshness(tables: dict[str, tuple[str, DataFrame, str]], now: str) -> DataFrame:
    """``max(loaded_at)`` per source table against ``now``: pass / warn / error.

    ``tables``: name -> (source, df, loaded_at column). ``now`` is a parameter
    so a check is reproducible.
    """
    now_ts = F.to_timestamp(F.lit(now))
    parts = []
    for name, (source, df, col) in tables.items():
        warn_h, err_h = FRESHNESS[source]
        m = df.agg(F.max(col).alias("max_loaded_at"))
        age = (F.unix_micros(now_ts) - F.unix_micros(F.col("max_loaded_at"))) / F.lit(3_600_000_000)
        status = F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        if err_h is not None:
            status = status.when(age > err_h, F.lit("error"))
        status = status.when(age > warn_h, F.lit("warn")).otherwise(F.lit("pass"))
        parts.append(m.select(
            F.lit(source).alias("source_name"), F.lit(name).alias("table_name"), "max_loaded_at",
            F.round(age, 3).alias("age_hours"), status.alias("status"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contract_check(spark: SparkSession, models: dict[str, DataFrame]) -> DataFrame:
    """Each mart's schema against its declared contract (names and types),
    with the row count of the table the contract guards."""
    parts = []
    for name, contract in CONTRACTS.items():
        try:
            check_schema(models[name].schema, contract)
            status, message = "pass", ""
        except SchemaDrift as e:
            status, message = "fail", str(e)
        parts.append(models[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), F.lit(status).alias("status"), F.lit(message).alias("message"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce_contract(df: DataFrame, name: str) -> DataFrame:
    """Raise before a write when the model drifted from its contract."""
    check_schema(df.schema, CONTRACTS[name])
    return df


def export_replay(fact_orders: DataFrame) -> DataFrame:
    """Orders to replay, in time order (range-partitioned global sort)."""
    return fact_orders.select("order_id", "customer_id", "ordered_at", "order_total", "item_count", "status").orderBy(
        "ordered_at", "order_id"
    )


def write_replay(replay: DataFrame, path: str) -> None:
    replay.write.mode("overwrite").option("compression", "zstd").parquet(path)


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows in ``order`` (0 = all): a top-k, not a full sort."""
    return df if n <= 0 else df.orderBy(*order).limit(n)


# Job log derived from the test events table ----------------------------------
INVOCATION_KEY = FX.INVOCATION_LABEL


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse job log: one job per event, labelled with its invocation.

    bytes = value in cents x 1 KiB (billed at least 10 MiB), slot time =
    k x 250 ms, end = creation + k seconds; error events are LOAD jobs, the
    rest QUERY jobs; view events carry no labels.
    """
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("long")
    processed = F.round(F.col("value") * 100).cast("long") * 1024
    labels = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(
        F.array(F.struct(F.lit(INVOCATION_KEY).alias("key"),
                         F.concat(F.lit("inv-"), (F.col("user_id") % 10).cast("string")).alias("value")))
    )
    return e.select(
        F.col("event_id").alias("job_id"),
        F.col("ts").cast("timestamp").alias("creation_time"),
        (F.col("ts").cast("timestamp") + F.make_interval(secs=k.cast("int"))).alias("end_time"),
        F.when(F.col("event_type") == "error", F.lit("LOAD")).otherwise(F.lit("QUERY")).alias("job_type"),
        processed.alias("total_bytes_processed"),
        F.greatest(processed, F.lit(10 * 1024 * 1024).cast("long")).alias("total_bytes_billed"),
        (k * 250).alias("total_slot_ms"),
        labels.alias("labels"),
    )


def job_log_rollup(log: DataFrame, invocation: str | None = None, since: dt.datetime | None = None) -> DataFrame:
    """Cost rollup of the QUERY jobs of a build, per invocation label.

    Jobs qualify with ``EXISTS`` over their label array (a higher-order
    function, no explode); ``invocation`` restricts to one build and ``since``
    to a time horizon. Nulls sum to 0, as in the report.
    """
    has_inv = F.exists("labels", lambda l: l["key"] == F.lit(INVOCATION_KEY))
    if invocation is not None:
        has_inv = F.exists("labels", lambda l: (l["key"] == F.lit(INVOCATION_KEY)) & (l["value"] == F.lit(invocation)))
    q = log.where((F.col("job_type") == FX.QUERY_JOB) & F.col("labels").isNotNull() & has_inv)
    if since is not None:
        q = q.where(F.col("creation_time") > F.lit(since))
    inv = F.filter("labels", lambda l: l["key"] == F.lit(INVOCATION_KEY))[0]["value"]
    g = q.groupBy(inv.alias("invocation_id")).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.coalesce(F.sum("total_bytes_billed"), F.lit(0)).alias("bytes_billed"),
        F.coalesce(F.sum("total_bytes_processed"), F.lit(0)).alias("bytes_processed"),
        F.coalesce(F.sum("total_slot_ms"), F.lit(0)).alias("slot_ms"),
        F.min("creation_time").alias("first_job"),
        F.max("end_time").alias("last_job"),
    )
    return g.select(
        "*",
        F.round(F.col("bytes_billed") / F.lit(2 ** 30), 3).alias("gib_billed"),
        F.round(F.col("bytes_billed") / F.lit(2 ** 40), 6).alias("tib_billed"),
        F.round(F.col("slot_ms") / F.lit(1000), 1).alias("slot_seconds"),
    )
