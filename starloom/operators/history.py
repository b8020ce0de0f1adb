"""The SCD Type 2 history as a published table in an open and a closed part.

Closed versions never change, so a run appends those it closes and leaves the
rest alone. Open versions stand in BUCKETS buckets by a hash of the key; a run
rewrites only the buckets in which a version opened or closed. So what a run
writes follows its changes: nothing without changes, and never the closed part.

Both parts change in one published version (``publish``), so a reader never
sees a customer with two open versions or with none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import publish
from starloom.operators.scd2 import META, first_snapshot
from starloom.session import scratch_path

PART, CLOSED = "history_part", "closed"
#: Buckets of the open part.
BUCKETS = 32


def _open_part(key: str):
    return F.concat(F.lit("open-"), F.lpad(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string"), 4, "0"))


def read_history(spark: SparkSession, table: str) -> DataFrame:
    """All versions, open and closed."""
    return publish.read(spark, table).drop(PART)


def run_snapshot(spark: SparkSession, current: DataFrame, table: str, key: str, updated_at: str = "updated_at") -> dict:
    """One snapshot run by the timestamp rule of ``scd2.snapshot``; publishes a version if anything changed.

    Returns how many versions opened and closed and how many open buckets were rewritten.
    """
    base = publish.resolve(spark, table)
    if base is None:
        first = first_snapshot(current, key, updated_at).withColumn(PART, _open_part(key))
        publish.create(spark, first, table, PART)
        return {"mode": "create"}
    cols = [c for c in base.schema.fieldNames() if c != PART]
    open_rows = publish.read(spark, table, base, only=[p for p in base.parts if p != CLOSED])
    held = open_rows.select(F.col(key).alias("_key"), F.col("dbt_valid_from").alias("_from"), F.struct(*cols).alias("_old"))
    moved = current.join(held, F.col(key) == F.col("_key"), "left").where(
        F.col("_key").isNull() | (F.col(updated_at) > F.col("_from")))
    staged = scratch_path(spark, "history", "changes")
    new = [F.col(c) for c in cols if c not in META]
    moved.select(*new, "_old").write.parquet(staged)  # the changes, computed once
    changes = spark.read.parquet(staged)
    opened = first_snapshot(changes.select(*new), key, updated_at).withColumn(PART, _open_part(key)).select(*base.schema.fieldNames())
    buckets = [r[0] for r in opened.select(PART).distinct().collect()]  # at most BUCKETS
    if not buckets:
        return {"mode": "noop", "opened": 0, "closed": 0, "buckets": 0}
    ended = changes.where(F.col("_old").isNotNull())
    closed = ended.select(*[(F.col(updated_at) if c == "dbt_valid_to" else F.col(f"_old.{c}")).alias(c) for c in cols],
                          F.lit(CLOSED).alias(PART)).select(*base.schema.fieldNames())
    kept = publish.read(spark, table, base, only=buckets).join(changes.select(key), key, "left_anti").select(*base.schema.fieldNames())
    n = changes.agg(F.count(F.lit(1)).alias("opened"), F.count("_old").alias("closed")).first()
    publish.replace(spark, table, base, buckets, kept.unionByName(opened), closed if n["closed"] else None)
    return {"mode": "changes", "opened": n["opened"], "closed": n["closed"], "buckets": len(buckets)}
