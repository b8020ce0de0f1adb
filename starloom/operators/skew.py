"""Equi joins whose hot keys are split over tasks, inside one plan.

AQE splits a skewed partition only of a plain sort-merge join. ``salted_join``
splits by key and works for any join that keeps left rows: a key with n left
rows gets ceil(n / rows_per_task) salts, its right rows are copied once per
salt. The salts are a DataFrame in the plan (no list on the driver, no job
while the plan is built). Only keys of more than ``rows_per_task`` rows are in
it, so it has at most rows / rows_per_task rows and is broadcast on that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Left rows of one key that a task should join at most.
ROWS_PER_TASK = 2_000_000


def key_salts(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(_salt_key, _salts) for the keys of more than ``rows_per_task`` rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_salt_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(
        "_salt_key", F.ceil(F.col("_n") / rows_per_task).cast("long").alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salt_by: list[str],
                how: str = "left", extra: Column | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Join on ``left_key == right_key`` (and ``extra``), hot left keys spread by a hash of ``salt_by``.

    The salt is a function of the row, so a task that runs again after a lost
    executor gives the same salts.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot split join type {how}")
    salts = key_salts(left, left_key, rows_per_task)

    def with_salts(df: DataFrame, key: str) -> DataFrame:
        return (df.join(F.broadcast(salts), df[key] == F.col("_salt_key"), "left").drop("_salt_key")
                .withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("long"))))

    spread = with_salts(left, left_key).withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.col("_salts"))).drop("_salts")
    copies = (with_salts(right, right_key)
              .withColumn("_salt_r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts"))
    cond = (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_salt_r"))
    return spread.join(copies, cond if extra is None else cond & extra, how).drop("_salt", "_salt_r")
