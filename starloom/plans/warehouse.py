"""The model graph as lazy DataFrames over one input location.

``Warehouse(spark, sf_dir)`` exposes every model as a property returning a
DataFrame; each model is built once per instance and reused downstream, so
one action compiles one plan in which Catalyst prunes columns and pushes
filters through all layers.

With ``persist=True`` the tables of the warehouse (raw landing, snapshot,
marts) are written once below the scratch root and read back, as a build
does: lineage is cut there, and the many test queries that read a mart scan
Parquet instead of recomputing it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import packed_text, unpacked_text
from starloom.operators import history, publish
from starloom.operators.incremental import delete_insert, newer_than, newer_than_target
from starloom.operators.quantile import spread_of
from starloom.operators.scd2 import snapshot
from starloom.plans import governance, marts, staging, stream_marts
from starloom.plans.intermediate import int_order_totals
from starloom.session import TABLE_COMPRESSION, prepare, scratch_path, size_shuffles
from starloom.sources import driver_tables as raw, fs

# Load stamp used when a run must be reproducible (oracle comparisons, tests).
FIXED_LOAD_STAMP = "2026-01-01 00:00:00"
# The first of the two incremental runs sees the orders placed before this day.
INCREMENTAL_CUTOFF = "1999-01-01 00:00:00"
# Warm-up horizon of the first-seen report: events from here on count.
FIRST_SEEN_T0 = "2024-01-02 00:00:00"

TABLE_MODELS = {
    "raw_customers", "raw_customer_updates", "raw_products", "raw_orders", "raw_order_items",
    "customers_snapshot_initial", "customers_snapshot", "dim_customer", "dim_product", "dim_date",
    "orders_with_customer", "fact_orders", "fact_order_items", "window_metrics",
}
# Tables with a digest a row or more, which hold them as bytes; readers see texts.
PACKED_MODELS = {"raw_order_items", "fact_orders", "fact_order_items"}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, loaded_at: str | None = FIXED_LOAD_STAMP,
                 persist: bool = False):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.loaded_at = loaded_at
        self.persist = persist
        self.paths: dict[str, str] = {}
        if persist:
            size_shuffles(self.spark, sum(fs.size(self.spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in raw.TEST_TABLES))

    def _table(self, name: str, df: DataFrame) -> DataFrame:
        if not self.persist or name not in TABLE_MODELS:
            return df
        if name not in PACKED_MODELS:
            return self._written(name, df)
        packed = self._written(name, df.select(*[packed_text(c).alias(c) if c in marts.DIGESTS else c for c in df.columns]))
        return packed.select(*[unpacked_text(c).alias(c) if c in marts.DIGESTS else c for c in packed.columns])

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "warehouse", name)
        df.write.parquet(path, compression=TABLE_COMPRESSION)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    # raw -------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return raw.RAW_BUILDERS[name](self.spark, self.sf_dir, self.loaded_at)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._table("raw_customers", self.raw("customers"))

    @cached_property
    def raw_customer_updates(self) -> DataFrame:
        return self._table("raw_customer_updates", raw.raw_customer_updates(
            self.spark, self.sf_dir, self.loaded_at, customers=self.raw_customers))

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._table("raw_products", self.raw("products"))

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self._table("raw_orders", self.raw("orders"))

    @cached_property
    def raw_order_items(self) -> DataFrame:
        return self._table("raw_order_items", self.raw("order_items"))

    # staging ---------------------------------------------------------------
    def stg_customers_as_of(self, include_updates: bool) -> DataFrame:
        return staging.stg_customers(self.raw_customers, self.raw_customer_updates, include_updates)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self.stg_customers_as_of(True)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw_products)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw_order_items)

    @cached_property
    def int_order_totals(self) -> DataFrame:
        return int_order_totals(self.stg_order_items)

    # snapshot: run once without the update batch, then with it -------------
    @cached_property
    def customers_snapshot_initial(self) -> DataFrame:
        return self._table("customers_snapshot_initial", snapshot(self.stg_customers_as_of(False), None, "customer_id"))

    @cached_property
    def customers_snapshot(self) -> DataFrame:
        return self._table(
            "customers_snapshot", snapshot(self.stg_customers, self.customers_snapshot_initial, "customer_id"))

    # marts -----------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._table("dim_customer", marts.dim_customer(self.customers_snapshot))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._table("dim_product", marts.dim_product(self.stg_products))

    @cached_property
    def dim_date(self) -> DataFrame:
        """Configured range widened to every order and event date."""
        covers = [self.stg_orders.select("ordered_at"), self.order_events.select("event_time")]
        return self._table("dim_date", marts.dim_date(self.spark, covers=covers))

    @cached_property
    def dim_date_config(self) -> DataFrame:
        """Configured range widened only to the event dates (the stream roll-up's)."""
        return marts.dim_date(self.spark, covers=[self.order_events.select("event_time")])

    @cached_property
    def orders_with_customer(self) -> DataFrame:
        return self._table("orders_with_customer", marts.orders_with_customer(self.stg_orders, self.dim_customer))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return self._table("fact_orders", marts.fact_orders(self.orders_with_customer, self.int_order_totals))

    @cached_property
    def odd_products(self) -> DataFrame:
        """Written, so that the lines' join knows how few they are."""
        return self._written("odd_products", marts.odd_products(self.stg_order_items, self.dim_product))

    @cached_property
    def fact_order_items(self) -> DataFrame:
        odd = self.odd_products if self.persist else None
        return self._table("fact_order_items", marts.fact_order_items(
            self.stg_order_items, self.orders_with_customer, self.dim_product, odd))

    # incremental: a first build before the cutoff is written, as a load finds it;
    # then an incremental run on the written table
    @cached_property
    def dim_customer_initial(self) -> DataFrame:
        return marts.dim_customer(self.customers_snapshot_initial)

    @cached_property
    def first_build_orders(self) -> DataFrame:
        return self.stg_orders.where(F.col("ordered_at") < F.to_timestamp(F.lit(INCREMENTAL_CUTOFF)))

    @cached_property
    def first_build_enriched(self) -> DataFrame:
        return self._written("first_build_orders", marts.orders_with_customer(
            self.first_build_orders, self.dim_customer_initial))

    @cached_property
    def fact_orders_first_build(self) -> DataFrame:
        totals = marts.totals_for(self.stg_order_items, self.first_build_orders)
        return self._written("fact_orders_first", marts.fact_orders(self.first_build_enriched, totals))

    @cached_property
    def fact_order_items_first_build(self) -> DataFrame:
        return self._written("fact_order_items_first", marts.fact_order_items(
            self.stg_order_items, self.first_build_enriched, self.dim_product, self.odd_products))

    def _new_placed(self, target: DataFrame) -> DataFrame:
        """Orders newer than the target with their customer version, written once."""
        return self._written("new_orders", marts.orders_with_customer(
            newer_than_target(self.stg_orders, "ordered_at", target), self.dim_customer))

    @cached_property
    def fact_orders_incremental(self) -> DataFrame:
        target = self.fact_orders_first_build
        enriched = self._new_placed(target)
        new = self._written("fact_orders_new", marts.fact_orders(enriched, marts.totals_for(self.stg_order_items, enriched)))
        return delete_insert(target, new, "order_id")

    @cached_property
    def fact_order_items_incremental(self) -> DataFrame:
        target = self.fact_order_items_first_build
        new = self._written("fact_order_items_new", marts.fact_order_items(
            self.stg_order_items, self._new_placed(target), self.dim_product))
        return delete_insert(target, new, "order_item_id")

    # published: the same loads as tables whose versions readers resolve
    @cached_property
    def customers_snapshot_published(self) -> DataFrame:
        """Two snapshot runs, the initial customers and then the update batch, on one published history."""
        path = scratch_path(self.spark, "published", "customers_snapshot")
        for include_updates in (False, True):
            history.run_snapshot(self.spark, self.stg_customers_as_of(include_updates), path, "customer_id")
        return history.read_history(self.spark, path)

    def _published(self, fact: str, first: DataFrame, key: str) -> DataFrame:
        """The first build published, then the orders behind its high-water mark loaded."""
        path = scratch_path(self.spark, "published", fact)
        month = F.date_format("ordered_at", "yyyy-MM").alias("order_month")
        publish.create(self.spark, first.select("*", month), path, "order_month", marts.DIGESTS)
        fresh = newer_than(self.stg_orders, "ordered_at", publish.high_water(self.spark, path, "ordered_at"))
        placed = self._written("new_orders", marts.orders_with_customer(fresh, self.dim_customer))
        if fact == "fact_orders":
            new = marts.fact_orders(placed, marts.totals_for(self.stg_order_items, placed))
        else:
            new = marts.fact_order_items(self.stg_order_items, placed, self.dim_product)
        publish.delete_insert(self.spark, new.select("*", month), path, key, marts.DIGESTS)
        return publish.read(self.spark, path).drop("order_month")

    @cached_property
    def fact_orders_published(self) -> DataFrame:
        return self._published("fact_orders", self.fact_orders_first_build, "order_id")

    @cached_property
    def fact_order_items_published(self) -> DataFrame:
        return self._published("fact_order_items", self.fact_order_items_first_build, "order_item_id")

    # governance --------------------------------------------------------------
    @cached_property
    def dim_customer_restricted(self) -> DataFrame:
        return governance.dim_customer_restricted(self.dim_customer)

    @cached_property
    def distinct_people(self) -> DataFrame:
        return governance.distinct_people(self.dim_customer_restricted)

    @cached_property
    def people_sketches(self) -> DataFrame:
        """One mergeable sketch of the people per sign-up day, kept as a table."""
        return self._written("people_sketches", governance.people_sketches(self.dim_customer_restricted))

    @cached_property
    def distinct_people_by_month(self) -> DataFrame:
        """People per sign-up month and in all: exact, and whether the merged daily sketches come near enough."""
        return governance.people_by_month(self.dim_customer_restricted, self.people_sketches)

    @cached_property
    def pii_inventory(self) -> DataFrame:
        return governance.pii_inventory(self.spark, [
            ("staging", "stg_customers", self.stg_customers),
            ("marts", "dim_customer", self.dim_customer),
        ])

    # stream side -------------------------------------------------------------
    @cached_property
    def order_events(self) -> DataFrame:
        return raw.order_events(self.spark, self.sf_dir)

    @cached_property
    def window_metrics(self) -> DataFrame:
        return self._table("window_metrics", stream_marts.window_metrics_batch(self.order_events))

    @cached_property
    def window_metrics_unrounded(self) -> DataFrame:
        return stream_marts.window_metrics_batch(self.order_events, rounded=False)

    @cached_property
    def stream_daily_metrics(self) -> DataFrame:
        return stream_marts.stream_daily_metrics(self.window_metrics, self.dim_date)

    @cached_property
    def ship_latency(self) -> DataFrame:
        return stream_marts.ship_latency(raw.read(self.spark, self.sf_dir, "orders"), raw.read(self.spark, self.sf_dir, "lineitem"))

    @cached_property
    def latency_detail(self) -> DataFrame:
        """Milliseconds from order to shipment by order month."""
        return stream_marts.spread(self.ship_latency, "latency_ms", ["order_month"], "latency")

    @cached_property
    def latency_summary(self) -> DataFrame:
        """The same over all lines; no task orders them all."""
        return spread_of(self.ship_latency, "latency_ms", "latency")

    @cached_property
    def window_first_seen(self) -> DataFrame:
        return stream_marts.first_seen(self.spark, self.order_events, FIRST_SEEN_T0)

    # everything the test suite reads ----------------------------------------
    def models(self) -> dict[str, DataFrame]:
        names = [
            "raw_customers", "raw_products", "raw_orders", "raw_order_items",
            "stg_customers", "stg_products", "stg_orders", "stg_order_items", "int_order_totals",
            "dim_date", "dim_product", "dim_customer", "fact_orders", "fact_order_items",
            "dim_customer_restricted", "stream_daily_metrics",
        ]
        return {n: getattr(self, n) for n in names}
