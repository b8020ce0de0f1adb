"""Declared schemas: money type, mart contracts and PII column tags.

Contracts are plain ``StructType`` objects. PII tags live in
``StructField.metadata["pii"]`` so the inventory is read from the schemas
themselves and cannot drift from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

from starloom import fixed as FX

# `numeric` of the warehouse: spelled out, because Spark's bare `numeric` is
# decimal(10,0) and would round cents away.
MONEY = T.DecimalType(FX.MONEY_PRECISION, FX.MONEY_SCALE)

PII = {"pii": True}


def _f(name: str, dtype: T.DataType, nullable: bool = True, pii: bool = False) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata=dict(PII) if pii else {})


L, S, B, D, TS, DBL = T.LongType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.DoubleType()

STG_CUSTOMERS = T.StructType([
    _f("customer_id", L), _f("first_name", S, pii=True), _f("last_name", S, pii=True),
    _f("email", S, pii=True), _f("phone", S, pii=True), _f("street_address", S, pii=True),
    _f("city", S), _f("state", S), _f("segment", S), _f("signup_date", D), _f("updated_at", TS),
])

DIM_DATE = T.StructType([
    _f("date_key", L), _f("date_day", D), _f("year", L), _f("quarter", L), _f("month", L),
    _f("month_name", S), _f("week_of_year", L), _f("day_of_month", L), _f("day_of_week", L),
    _f("day_name", S), _f("is_weekend", B),
])

DIM_PRODUCT = T.StructType([
    _f("product_sk", S), _f("product_id", L), _f("product_name", S), _f("department", S),
    _f("aisle_id", L), _f("list_price", MONEY), _f("is_active", B),
])

DIM_CUSTOMER = T.StructType([
    _f("customer_sk", S), _f("customer_id", L), _f("first_name", S, pii=True), _f("last_name", S, pii=True),
    _f("email", S, pii=True), _f("phone", S, pii=True), _f("street_address", S, pii=True),
    _f("city", S), _f("state", S), _f("segment", S), _f("signup_date", D),
    _f("valid_from", TS), _f("valid_to", TS), _f("is_current", B),
])

FACT_ORDERS = T.StructType([
    _f("order_id", L), _f("customer_sk", S), _f("customer_id", L), _f("date_key", L), _f("ordered_at", TS),
    _f("status", S), _f("channel", S), _f("promo_code", S), _f("item_count", L), _f("unit_count", L),
    _f("gross_amount", MONEY), _f("discount_amount", MONEY), _f("order_total", MONEY),
])

FACT_ORDER_ITEMS = T.StructType([
    _f("order_item_id", S), _f("order_id", L), _f("line_number", L), _f("customer_sk", S),
    _f("product_sk", S), _f("product_id", L), _f("date_key", L), _f("ordered_at", TS),
    _f("quantity", L), _f("unit_price", MONEY), _f("discount", MONEY), _f("line_total", MONEY),
])

# The stream sink table (one row per closed one-minute window).
WINDOW_METRICS = T.StructType([
    _f("window_start", TS), _f("window_end", TS), _f("order_count", L), _f("revenue", DBL),
    _f("avg_basket_size", DBL), _f("emitted_at", TS), _f("loaded_at", TS), _f("latency_ms", L),
])

# A JSON order event as the producer writes it.
ORDER_EVENT = T.StructType([
    _f("order_id", L), _f("customer_id", L), _f("order_total", DBL), _f("item_count", T.IntegerType()),
    _f("status", S), _f("event_time", TS), _f("produced_at", TS),
])

# Contracts of the mart tables (schema must match exactly before a write).
CONTRACTS = {
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "fact_orders": FACT_ORDERS,
    "fact_order_items": FACT_ORDER_ITEMS,
}

# Models whose schemas carry PII tags, with the schema (namespace) they live in.
TAGGED_MODELS = [
    ("staging", "stg_customers", STG_CUSTOMERS),
    ("marts", "dim_customer", DIM_CUSTOMER),
]
