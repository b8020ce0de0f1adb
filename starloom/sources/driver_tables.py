"""Driver test tables shaped into the warehouse's raw tables.

The warehouse lands five raw tables (customers, customer_updates, products,
orders, order_items) plus an order-event stream. The test data is TPC-H-like,
so each raw table is a projection of one test table with integer/text rules
only (no hashing of doubles), so DuckDB can reproduce every value.

Reads are column-pruned by construction: only the columns a rule needs are
referenced, and Parquet ``ReadSchema`` shows just those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import money, surrogate_key

# ---------------------------------------------------------------------------
# Fixed values of the mapping (must equal the oracle SQL's literals).
# Email domains, picked by customer key modulo 5, in this order:
EMAIL_DOMAINS = ["example.com", "mail.test", "inbox.test", "post.test", "shop.test"]
# Market segment -> customer segment of the warehouse (new, regular, loyal, vip):
SEGMENTS = {"AUTOMOBILE": "new", "BUILDING": "regular", "FURNITURE": "loyal", "HOUSEHOLD": "loyal", "MACHINERY": "vip"}
# Order status letter -> status word:
STATUSES = {"F": "completed", "O": "cancelled", "P": "returned"}
# First character of the order priority -> sales channel (others: web):
CHANNELS = {"1": "ios", "2": "android"}
DEFAULT_CHANNEL = "web"
# Promo code on every 8th order key.
PROMO_CODE = "SAVE10"
PROMO_EVERY = 8
# Clock of the initial customer load and of the update batch.
INITIAL_UPDATED_AT = "1994-12-31 00:00:00"
UPDATE_UPDATED_AT = "1998-01-01 00:00:00"
SIGNUP_BASE = "1990-01-01"
SIGNUP_SPREAD_DAYS = 1095
# Customers that move (key divisible by 13) and that become vip (by 33).
MOVE_EVERY = 13
UPGRADE_EVERY = 33
UPGRADE_SEGMENT = "vip"
# Products whose key is divisible by 25 are inactive.
INACTIVE_EVERY = 25
# Event types: 'purchase' is a completed order in the stream.
PURCHASE = "purchase"
# ---------------------------------------------------------------------------

TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet ``timestamp[us]`` arrives as TIMESTAMP_NTZ."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(default) if default is not None else out


def _stamp(loaded_at: str | None) -> Column:
    return F.current_timestamp() if loaded_at is None else F.to_timestamp(F.lit(loaded_at))


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H tables; the
    # planner broadcasts them on its own size threshold. They are joined first, so that customers move once at most.
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return c.join(n.join(r, n.n_regionkey == r.r_regionkey), c.c_nationkey == n.n_nationkey)


def _phone(k: Column) -> Column:
    area = F.lpad((F.lit(200) + k % 799).cast("string"), 3, "0")
    mid = F.lpad((F.lit(200) + (k * 7) % 799).cast("string"), 3, "0")
    last = F.lpad(((k * 13) % 10000).cast("string"), 4, "0")
    return F.concat(F.lit("+1-"), area, F.lit("-"), mid, F.lit("-"), last)


def _email(k: Column, segment_text: Column) -> Column:
    domain = F.element_at(F.array(*[F.lit(d) for d in EMAIL_DOMAINS]), (k % len(EMAIL_DOMAINS) + 1).cast("int"))
    return F.concat(segment_text, F.lit("."), k.cast("string"), F.lit("@"), domain)


def raw_customers(spark: SparkSession, sf_dir: str, loaded_at: str | None = None) -> DataFrame:
    """raw.customers: initial customer master (upper-case emails on purpose)."""
    b = _customer_base(spark, sf_dir)
    k = F.col("c_custkey")
    return b.select(
        k.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        _email(k, F.col("c_mktsegment")).alias("email"),
        _phone(k).alias("phone"),
        F.concat((k % 9999).cast("string"), F.lit(" Main St")).alias("street_address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        _case(F.col("c_mktsegment"), SEGMENTS).alias("segment"),
        F.date_add(F.to_date(F.lit(SIGNUP_BASE)), (k % SIGNUP_SPREAD_DAYS).cast("int")).cast("timestamp").alias("signup_date"),
        F.to_timestamp(F.lit(INITIAL_UPDATED_AT)).alias("updated_at"),
        _stamp(loaded_at).alias("_loaded_at"),
    )


def raw_customer_updates(spark: SparkSession, sf_dir: str, loaded_at: str | None = None,
                         customers: DataFrame | None = None) -> DataFrame:
    """raw.customer_updates: movers get a new city/street, some become vip."""
    base = customers if customers is not None else raw_customers(spark, sf_dir, loaded_at)
    k = F.col("customer_id")
    moved = (k % MOVE_EVERY) == 0
    upgraded = (k % UPGRADE_EVERY) == 0
    return base.where(moved | upgraded).select(
        "customer_id", "first_name", "last_name", "email", "phone",
        F.when(moved, F.concat((k % 9999).cast("string"), F.lit(" Harbor Rd"))).otherwise(F.col("street_address")).alias("street_address"),
        F.when(moved, F.concat(F.lit("MOVED_"), F.col("city"))).otherwise(F.col("city")).alias("city"),
        "state",
        F.when(upgraded, F.lit(UPGRADE_SEGMENT)).otherwise(F.col("segment")).alias("segment"),
        "signup_date",
        F.to_timestamp(F.lit(UPDATE_UPDATED_AT)).alias("updated_at"),
        "_loaded_at",
    )


def raw_products(spark: SparkSession, sf_dir: str, loaded_at: str | None = None) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("department"),
        F.col("p_size").cast("long").alias("aisle_id"),
        F.col("p_retailprice").alias("unit_price"),
        ((F.col("p_partkey") % INACTIVE_EVERY) != 0).alias("is_active"),
        _stamp(loaded_at).alias("_loaded_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str, loaded_at: str | None = None) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        _case(F.col("o_orderstatus"), STATUSES).alias("status"),
        _case(F.left("o_orderpriority", F.lit(1)), CHANNELS, F.lit(DEFAULT_CHANNEL)).alias("channel"),
        F.when(k % PROMO_EVERY == 0, F.lit(PROMO_CODE)).alias("promo_code"),
        _stamp(loaded_at).alias("_loaded_at"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str, loaded_at: str | None = None) -> DataFrame:
    """raw.order_items: one row per line; money columns exact in decimal.

    order_item_id is the surrogate key of all columns that identify a line, so
    the largest table is neither sorted nor shuffled to be numbered.
    """
    li = read(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("long")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        surrogate_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", qty).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        money(qty.cast("decimal(18,0)") * price * F.col("l_discount").cast("decimal(4,2)")).alias("discount"),
        _stamp(loaded_at).alias("_loaded_at"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events (the stream's payload) from the test ``events`` table.

    A purchase is a completed order; other event types keep their name as
    status and advance event time like heartbeats do.
    """
    e = read(spark, sf_dir, "events")
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


RAW_BUILDERS = {
    "customers": raw_customers,
    "customer_updates": raw_customer_updates,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
}
