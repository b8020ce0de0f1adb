"""Staging: typed projections of the raw tables (views, i.e. lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import money, to_money
from starloom.operators.latest import latest_per_key
from starloom.schemas import STG_CUSTOMERS


def _tagged(df: DataFrame, schema) -> DataFrame:
    """Re-attach column metadata (PII tags); a cast drops it."""
    meta = {f.name: f.metadata for f in schema.fields}
    return df.select(*[F.col(c).alias(c, metadata=meta[c]) if meta.get(c) else F.col(c) for c in df.columns])


def stg_customers(customers: DataFrame, updates: DataFrame | None, include_updates: bool = True) -> DataFrame:
    """Latest state per customer: initial load, overridden by the update batch."""
    unioned = customers if not include_updates else customers.unionByName(updates)
    typed = unioned.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("first_name").cast("string").alias("first_name"),
        F.col("last_name").cast("string").alias("last_name"),
        F.lower(F.col("email").cast("string")).alias("email"),
        F.col("phone").cast("string").alias("phone"),
        F.col("street_address").cast("string").alias("street_address"),
        F.col("city").cast("string").alias("city"),
        F.col("state").cast("string").alias("state"),
        F.col("segment").cast("string").alias("segment"),
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )
    return _tagged(latest_per_key(typed, "customer_id", ["updated_at"]), STG_CUSTOMERS)


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").cast("long").alias("product_id"),
        F.col("product_name").cast("string").alias("product_name"),
        F.col("department").cast("string").alias("department"),
        F.col("aisle_id").cast("long").alias("aisle_id"),
        to_money(F.col("unit_price")).alias("list_price"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("order_id").cast("long").alias("order_id"),
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("ordered_at").cast("timestamp").alias("ordered_at"),
        F.col("status").cast("string").alias("status"),
        F.col("channel").cast("string").alias("channel"),
        F.col("promo_code").cast("string").alias("promo_code"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    """line_total is computed from the raw columns, before the money casts."""
    return items.select(
        F.col("order_item_id").cast("string").alias("order_item_id"),
        F.col("order_id").cast("long").alias("order_id"),
        F.col("line_number").cast("long").alias("line_number"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("quantity").cast("long").alias("quantity"),
        to_money(F.col("unit_price")).alias("unit_price"),
        to_money(F.col("discount")).alias("discount"),
        money(F.col("quantity") * F.col("unit_price") - F.col("discount")).alias("line_total"),
    )
