"""SCD Type 2 snapshot with the timestamp strategy.

``snapshot(current, history)`` returns the next version of ``history``:

* key not open in history  -> open a row: valid_from = updated_at, valid_to NULL
* open row and updated_at > its valid_from -> close it at updated_at, open a new row
* otherwise (same or older clock) -> unchanged, even if other values differ
* closed rows never change; keys missing from ``current`` stay open

Only open rows take part in the join (one per key, so the join cannot skew);
closed history is passed through without a shuffle. Each joined row emits one
or two output rows through a single ``explode``, so the join runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import surrogate_key

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def empty_history(current: DataFrame) -> DataFrame:
    schema = T.StructType(
        list(current.schema.fields)
        + [
            T.StructField("dbt_scd_id", T.StringType()),
            T.StructField("dbt_updated_at", T.TimestampType()),
            T.StructField("dbt_valid_from", T.TimestampType()),
            T.StructField("dbt_valid_to", T.TimestampType()),
        ]
    )
    return current.sparkSession.createDataFrame([], schema)


def first_snapshot(current: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """No history yet: every current row opens a version (no join needed)."""
    upd = F.col(updated_at)
    return current.select(
        "*",
        surrogate_key(F.col(key), upd).alias("dbt_scd_id"),
        upd.alias("dbt_updated_at"),
        upd.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )


def snapshot(current: DataFrame, history: DataFrame | None, key: str, updated_at: str = "updated_at") -> DataFrame:
    if history is None:
        return first_snapshot(current, key, updated_at)
    cols = current.columns
    out_cols = cols + META
    open_rows = history.where(F.col("dbt_valid_to").isNull())
    closed_rows = history.where(F.col("dbt_valid_to").isNotNull()).select(*out_cols)

    c = current.select(*[F.col(x).alias(f"c_{x}") for x in cols])
    h = open_rows.select(*[F.col(x).alias(f"h_{x}") for x in out_cols])
    j = c.join(h, F.col(f"c_{key}") == F.col(f"h_{key}"), "full_outer")

    c_upd = F.col(f"c_{updated_at}")
    opened = F.struct(
        *[F.col(f"c_{x}").alias(x) for x in cols],
        surrogate_key(F.col(f"c_{key}"), c_upd).alias("dbt_scd_id"),
        c_upd.alias("dbt_updated_at"),
        c_upd.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )
    kept = F.struct(*[F.col(f"h_{x}").alias(x) for x in out_cols])
    closed = F.struct(*[(c_upd if x == "dbt_valid_to" else F.col(f"h_{x}")).alias(x) for x in out_cols])

    is_new = F.col(f"h_{key}").isNull()
    is_change = F.col(f"c_{key}").isNotNull() & (c_upd > F.col("h_dbt_valid_from"))
    rows = (
        F.when(is_new, F.array(opened))
        .when(is_change, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    moved = j.select(F.explode(rows).alias("r")).select(*[F.col(f"r.{x}").alias(x) for x in out_cols])
    return closed_rows.unionByName(moved)
