"""Intermediate models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import money


def int_order_totals(stg_items: DataFrame) -> DataFrame:
    """Order totals from the lines (partial aggregate map-side, final after the shuffle)."""
    return stg_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").alias("unit_count"),
        money(F.sum(F.col("quantity") * F.col("unit_price"))).alias("gross_amount"),
        money(F.sum("discount")).alias("discount_amount"),
        money(F.sum("line_total")).alias("order_total"),
    )
