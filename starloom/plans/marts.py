"""Marts: the star schema (three dimensions, two facts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import fixed as FX
from starloom.functions import date_key, date_name, date_part, day_spine_covering, is_weekend, money, packed_text, surrogate_key, unpacked_text
from starloom.operators.asof import asof_left_join
from starloom.plans.intermediate import int_order_totals
from starloom.plans.staging import _tagged
from starloom.schemas import DIM_CUSTOMER

# dim_date range: the configured range, widened to the dates of the data the
# calendar serves (order dates start in 1995 in the test data).
CONFIG_DATE_START, CONFIG_DATE_END = FX.CONFIG_DATE_START, FX.CONFIG_DATE_END
# The facts' surrogate keys, which move as bytes.
DIGESTS = ["order_item_id", "customer_sk", "product_sk"]


def dim_date(spark: SparkSession, start: str = CONFIG_DATE_START, end: str = CONFIG_DATE_END,
             covers: list[DataFrame] | None = None) -> DataFrame:
    """One row per day of [start, end], widened to cover the dates in ``covers``."""
    d = F.col("date_day")
    return day_spine_covering(spark, start, end, covers or []).select(
        date_key(d).alias("date_key"),
        d,
        date_part("year", d).alias("year"),
        date_part("quarter", d).alias("quarter"),
        date_part("month", d).alias("month"),
        date_name(d, "month").alias("month_name"),
        date_part("isoweek", d).alias("week_of_year"),
        date_part("day", d).alias("day_of_month"),
        date_part("isodow", d).alias("day_of_week"),
        date_name(d, "weekday").alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def _product_sk() -> Column:
    """The key that the dimension gives a product."""
    return surrogate_key("product_id")


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        _product_sk().alias("product_sk"),
        "product_id", "product_name", "department", "aisle_id", "list_price", "is_active",
    )


def dim_customer(snapshot: DataFrame) -> DataFrame:
    """One row per customer version, from the SCD2 snapshot."""
    out = snapshot.select(
        surrogate_key("customer_id", "dbt_valid_from").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "phone", "street_address",
        "city", "state", "segment", "signup_date",
        F.col("dbt_valid_from").cast("timestamp").alias("valid_from"),
        F.col("dbt_valid_to").cast("timestamp").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )
    return _tagged(out, DIM_CUSTOMER)


def orders_with_customer(stg_orders: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Orders with the customer_sk of the version current at ``ordered_at``.

    Shared by both facts: the as-of join runs once per build on the order
    headers, and the (larger) lines only join the result on order_id.
    """
    return asof_left_join(stg_orders, dim_cust, key="customer_id", ts="ordered_at", payload=["customer_sk"])


def fact_orders(enriched_orders: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per order; orders without lines get zero totals. The digest moves as bytes."""
    t = enriched_orders.withColumn("customer_sk", packed_text("customer_sk")).join(totals, "order_id", "left")
    return t.select(
        "order_id", unpacked_text("customer_sk").alias("customer_sk"), "customer_id",
        date_key("ordered_at").alias("date_key"),
        "ordered_at", "status", "channel", "promo_code",
        F.coalesce(F.col("item_count"), F.lit(0)).cast("long").alias("item_count"),
        F.coalesce(F.col("unit_count"), F.lit(0)).cast("long").alias("unit_count"),
        money(F.coalesce(F.col("gross_amount"), F.lit(0))).alias("gross_amount"),
        money(F.coalesce(F.col("discount_amount"), F.lit(0))).alias("discount_amount"),
        money(F.coalesce(F.col("order_total"), F.lit(0))).alias("order_total"),
    )


def odd_products(stg_items: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """(product_id, product_sk) of the lines' products that do not stand in the dimension just once with the key of their id.

    A row each time such a product stands there, one without a key if it does not. Only product ids move.
    """
    sold = stg_items.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    known = dim_prod.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"), F.min("product_sk").alias("_sk"))
    plain = known.where((F.col("_n") == 1) & (F.col("_sk") == _product_sk())).select("product_id")
    return sold.join(plain, "product_id", "left_anti").join(dim_prod.select("product_id", "product_sk"), "product_id", "left")


def fact_order_items(stg_items: DataFrame, enriched_orders: DataFrame, dim_prod: DataFrame, odd: DataFrame | None = None) -> DataFrame:
    """One row per order line, with the customer version and product keys.

    Lines inner-join their order on order_id by a plain shuffle join, whose hot
    orders AQE splits; whether the product dimension is broadcast is left to
    its size at run time. Lines move twice, with their digests as bytes. With the
    written ``odd_products`` they join those few alone and move once: every other
    product has the key of its id.
    """
    o = enriched_orders.select("order_id", "ordered_at", packed_text("customer_sk").alias("customer_sk"))
    p = (dim_prod if odd is None else odd).select("product_sk", F.col("product_id").alias("_p_id"))
    lines = stg_items.withColumn("order_item_id", packed_text("order_item_id"))
    j = lines.join(o, "order_id", "inner").join(p, F.col("product_id") == F.col("_p_id"), "left")
    if odd is not None:
        by_rule = F.col("_p_id").isNull() & F.col("product_id").isNotNull()
        j = j.withColumn("product_sk", F.when(by_rule, _product_sk()).otherwise(F.col("product_sk")))
    return j.select(
        unpacked_text("order_item_id").alias("order_item_id"), "order_id", "line_number",
        unpacked_text("customer_sk").alias("customer_sk"), "product_sk", "product_id",
        date_key("ordered_at").alias("date_key"),
        "ordered_at", "quantity", "unit_price", "discount", "line_total",
    )


def totals_for(stg_items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Order totals; on incremental runs only for the orders being loaded."""
    items = stg_items if orders is None else stg_items.join(orders.select("order_id"), "order_id", "left_semi")
    return int_order_totals(items)
