"""The warehouse's declared test suite, its singular tests and the quality log.

``CHECKS`` is the declaration (what a schema file would list): 8 source
tests, 24 staging, 3 intermediate, 41 marts, 2 governance, 2 streaming = 80.
Four singular tests bring the suite to 84. Added here: one stricter SCD2
check (exactly one current version per customer) and two warn-level probes
on the raw line key and on orders without lines, which fail on the test data
and keep the failure path exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import fixed as FX
from starloom.operators.quality import Check, evaluate, results_frame, run_checks, with_status

SEGMENTS = FX.CUSTOMER_SEGMENTS
STATUSES = FX.ORDER_STATUSES
CHANNELS = FX.ORDER_CHANNELS


def _u(model, col, **kw):
    return Check(model, col, "unique", **kw)


def _nn(model, col, **kw):
    return Check(model, col, "not_null", **kw)


def _av(model, col, values, **kw):
    return Check(model, col, "accepted_values", values=values, **kw)


def _rel(model, col, to_model, to_col, **kw):
    return Check(model, col, "relationships", to_model=to_model, to_column=to_col, **kw)


CHECKS: list[Check] = [
    # sources (8)
    _u("raw_customers", "customer_id", source=True), _nn("raw_customers", "customer_id", source=True),
    _u("raw_products", "product_id", source=True), _nn("raw_products", "product_id", source=True),
    _u("raw_orders", "order_id", source=True), _nn("raw_orders", "order_id", source=True),
    _u("raw_order_items", "order_item_id", source=True), _nn("raw_order_items", "order_item_id", source=True),
    # staging (24)
    _u("stg_customers", "customer_id"), _nn("stg_customers", "customer_id"), _nn("stg_customers", "email"),
    _av("stg_customers", "segment", SEGMENTS), _nn("stg_customers", "updated_at"),
    _u("stg_products", "product_id"), _nn("stg_products", "product_id"), _nn("stg_products", "product_name"),
    _nn("stg_products", "department"), _nn("stg_products", "list_price"),
    _u("stg_orders", "order_id"), _nn("stg_orders", "order_id"), _nn("stg_orders", "customer_id"),
    _rel("stg_orders", "customer_id", "stg_customers", "customer_id"), _nn("stg_orders", "ordered_at"),
    _av("stg_orders", "status", STATUSES), _av("stg_orders", "channel", CHANNELS),
    _u("stg_order_items", "order_item_id"), _nn("stg_order_items", "order_item_id"),
    _nn("stg_order_items", "order_id"), _rel("stg_order_items", "order_id", "stg_orders", "order_id"),
    _nn("stg_order_items", "product_id"), _rel("stg_order_items", "product_id", "stg_products", "product_id"),
    _nn("stg_order_items", "quantity"),
    # intermediate (3)
    _u("int_order_totals", "order_id"), _nn("int_order_totals", "order_id"), _nn("int_order_totals", "order_total"),
    # marts (41)
    _u("dim_date", "date_key"), _nn("dim_date", "date_key"), _u("dim_date", "date_day"), _nn("dim_date", "date_day"),
    _u("dim_product", "product_sk"), _nn("dim_product", "product_sk"), _u("dim_product", "product_id"),
    _nn("dim_product", "product_id"), _nn("dim_product", "product_name"), _nn("dim_product", "department"),
    _nn("dim_product", "list_price"),
    _u("dim_customer", "customer_sk"), _nn("dim_customer", "customer_sk"), _nn("dim_customer", "customer_id"),
    _nn("dim_customer", "email"), _av("dim_customer", "segment", SEGMENTS), _nn("dim_customer", "valid_from"),
    _nn("dim_customer", "is_current"),
    _u("fact_orders", "order_id"), _nn("fact_orders", "order_id"), _nn("fact_orders", "customer_sk"),
    _rel("fact_orders", "customer_sk", "dim_customer", "customer_sk"), _nn("fact_orders", "customer_id"),
    _nn("fact_orders", "date_key"), _rel("fact_orders", "date_key", "dim_date", "date_key"),
    _nn("fact_orders", "ordered_at"), _av("fact_orders", "status", STATUSES), _nn("fact_orders", "order_total"),
    _u("fact_order_items", "order_item_id"), _nn("fact_order_items", "order_item_id"),
    _nn("fact_order_items", "order_id"), _rel("fact_order_items", "order_id", "fact_orders", "order_id"),
    _nn("fact_order_items", "customer_sk"), _rel("fact_order_items", "customer_sk", "dim_customer", "customer_sk"),
    _nn("fact_order_items", "product_sk"), _rel("fact_order_items", "product_sk", "dim_product", "product_sk"),
    _nn("fact_order_items", "date_key"), _rel("fact_order_items", "date_key", "dim_date", "date_key"),
    _nn("fact_order_items", "ordered_at"), _nn("fact_order_items", "quantity"), _nn("fact_order_items", "line_total"),
    # governance (2)
    _u("dim_customer_restricted", "customer_sk"), _nn("dim_customer_restricted", "customer_sk"),
    # streaming (2)
    _u("stream_daily_metrics", "date_day"), _nn("stream_daily_metrics", "date_day"),
    # warn-level probes (fail on the test data by design)
    _u("raw_order_items", "order_id,line_number", severity="warn", name_override="probe_unique_raw_order_items_order_line"),
    _rel("stg_orders", "order_id", "stg_order_items", "order_id", severity="warn",
         name_override="probe_relationships_orders_have_lines"),
]

SINGULAR = [
    "assert_no_negative_quantities",
    "assert_order_totals_reconcile",
    "assert_scd2_versions_do_not_overlap",
    "assert_analyst_views_have_no_raw_pii",
    "assert_one_current_version_per_customer",
]


# singular tests: each returns its offending rows ---------------------------
def no_negative_quantities(fact_items: DataFrame) -> DataFrame:
    return fact_items.where((F.col("quantity") <= 0) | (F.col("unit_price") < 0) | (F.col("line_total") < 0))


def order_totals_reconcile(fact_orders: DataFrame, fact_items: DataFrame) -> DataFrame:
    lines = fact_items.groupBy("order_id").agg(F.sum("line_total").alias("line_sum"))
    j = fact_orders.select("order_id", "order_total").join(lines, "order_id")
    return j.where(F.abs(F.col("order_total") - F.col("line_sum")) > F.lit(FX.RECONCILE_TOLERANCE).cast("decimal(4,3)")).select(
        "order_id", "order_total", F.col("line_sum").cast("decimal(18,3)").alias("line_sum")
    )


def scd2_versions_do_not_overlap(dim_customer: DataFrame) -> DataFrame:
    """Versions of a customer must chain: valid_to = next valid_from, last one current.

    A window per customer; versions per customer are few (one per change),
    so a partition is one customer's history, not its orders.
    """
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    o = dim_customer.select(
        "customer_id", "valid_from", "valid_to", "is_current", F.lead("valid_from").over(w).alias("next_from")
    )
    bad = (F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))) | (
        F.col("next_from").isNull() & ~F.col("is_current")
    )
    return o.where(bad)


def one_current_version(dim_customer: DataFrame) -> DataFrame:
    """Stricter than the chain test: a NULL valid_to on a non-last row passes
    that one; here every customer must have exactly one current row."""
    per = dim_customer.groupBy("customer_id").agg(F.count_if(F.col("is_current")).alias("current_rows"))
    return per.where(F.col("current_rows") != 1)


def analyst_views_have_no_raw_pii(restricted: DataFrame) -> DataFrame:
    return restricted.where(
        ~F.col("email_masked").like(FX.EMAIL_MASK_PATTERN) | ~F.col("phone_masked").like(FX.PHONE_MASK_PATTERN)
    ).select("customer_sk", "email_masked", "phone_masked")


def singular_offenders(models: dict[str, DataFrame]) -> dict[str, tuple[str, DataFrame]]:
    return {
        "assert_no_negative_quantities": ("fact_order_items", no_negative_quantities(models["fact_order_items"])),
        "assert_order_totals_reconcile": (
            "fact_orders", order_totals_reconcile(models["fact_orders"], models["fact_order_items"])),
        "assert_scd2_versions_do_not_overlap": ("dim_customer", scd2_versions_do_not_overlap(models["dim_customer"])),
        "assert_analyst_views_have_no_raw_pii": (
            "dim_customer_restricted", analyst_views_have_no_raw_pii(models["dim_customer_restricted"])),
        "assert_one_current_version_per_customer": ("dim_customer", one_current_version(models["dim_customer"])),
    }


def checks_of(kind: str) -> list[Check]:
    return [c for c in CHECKS if c.test == kind]


def results(models: dict[str, DataFrame], checks: list[Check] | None = None, with_singular: bool = True) -> DataFrame:
    """One row per test with status (pass / fail / warn), evaluated now."""
    spark = next(iter(models.values())).sparkSession
    rows = evaluate(models, CHECKS if checks is None else checks, singular_offenders(models) if with_singular else None)
    return results_frame(spark, rows)


def results_lazy(models: dict[str, DataFrame], checks: list[Check] | None = None,
                 with_singular: bool = True) -> DataFrame:
    """The same table as one lazy plan."""
    return with_status(run_checks(models, CHECKS if checks is None else checks,
                                  singular_offenders(models) if with_singular else None))


# The model graph of a build: 13 models and the snapshot.
BUILT_MODELS = [
    ("model", "stg_customers"), ("model", "stg_products"), ("model", "stg_orders"), ("model", "stg_order_items"),
    ("model", "int_order_totals"), ("snapshot", "customers_snapshot"), ("model", "dim_customer"),
    ("model", "dim_date"), ("model", "dim_product"), ("model", "fact_orders"), ("model", "fact_order_items"),
    ("model", "dim_customer_restricted"), ("model", "pii_inventory"), ("model", "stream_daily_metrics"),
]
PROJECT = "starloom"


def run_results(spark: SparkSession, test_results: DataFrame, models: list[tuple[str, str]] | None = None,
                model_status: str = "success") -> DataFrame:
    """One row per executed node: ``(unique_id, status, failures, message)``.

    Node ids follow ``<type>.<project>.<name>``; tests carry their failure
    count and message.
    """
    node_rows = [(f"{kind}.{PROJECT}.{name}", model_status, None, "") for kind, name in (models or BUILT_MODELS)]
    nodes = spark.createDataFrame(node_rows, "unique_id string, status string, failures long, message string")
    tests = test_results.select(
        F.concat(F.lit(f"test.{PROJECT}."), F.col("test_name")).alias("unique_id"),
        "status", "failures",
        F.when(F.col("failures") > 0, F.concat(F.lit("Got "), F.col("failures").cast("string"), F.lit(" results")))
        .alias("message"),
    )
    return nodes.unionByName(tests)


def dq_summary(spark: SparkSession, results: DataFrame, built_at: str, invocation_id: str,
               command: str = "build", build_seconds: float | None = None) -> DataFrame:
    """One row per build from its run results, classified by node id:
    tests are ids starting with ``test.``; models are ``model.``, ``snapshot.``
    or ``seed.`` ids."""
    uid = F.col("unique_id")
    is_test = uid.startswith("test.")
    is_model = F.split_part(uid, F.lit("."), F.lit(1)).isin("model", "snapshot", "seed")
    st = F.col("status")
    s = results.agg(
        F.count_if(is_model & (st == "success")).alias("models_built"),
        F.count_if(is_model & (st == "error")).alias("models_failed"),
        F.count_if(is_test).alias("tests_run"),
        F.count_if(is_test & (st == "pass")).alias("tests_passed"),
        F.count_if(is_test & st.isin("fail", "error")).alias("tests_failed"),
        F.count_if(is_test & (st == "warn")).alias("tests_warned"),
    )
    return s.select(
        F.to_timestamp(F.lit(built_at)).alias("built_at"),
        F.lit(invocation_id).alias("invocation_id"),
        F.lit(command).alias("command"),
        "models_built", "models_failed", "tests_run", "tests_passed", "tests_failed", "tests_warned",
        F.lit(build_seconds).cast("double").alias("build_seconds"),
        F.round(F.lit(100.0) * F.col("tests_passed") / F.greatest(F.lit(1), F.col("tests_run")), 1).alias("pass_pct"),
    )


def dq_failures(results: DataFrame, built_at: str, invocation_id: str) -> DataFrame:
    """One row per failed / errored / warned test; the name is the third id part."""
    uid = F.col("unique_id")
    return results.where(uid.startswith("test.") & F.col("status").isin("fail", "error", "warn")).select(
        F.to_timestamp(F.lit(built_at)).alias("built_at"),
        F.lit(invocation_id).alias("invocation_id"),
        F.split_part(uid, F.lit("."), F.lit(3)).alias("test_name"),
        "status",
        F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"),
        F.left(F.coalesce(F.col("message"), F.lit("")), F.lit(FX.MESSAGE_LIMIT)).alias("message"),
    )


def append_log(results: DataFrame, path: str, built_at: str, invocation_id: str, build_seconds: float | None = None) -> None:
    """Append one build's summary and failures to the quality log below ``path``."""
    spark = results.sparkSession
    dq_summary(spark, results, built_at, invocation_id, build_seconds=build_seconds).write.mode("append").parquet(f"{path}/dq_summary")
    dq_failures(results, built_at, invocation_id).write.mode("append").parquet(f"{path}/dq_failures")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log by build: its summary and how many failures it logged."""
    failed = spark.read.parquet(f"{path}/dq_failures").groupBy("invocation_id").agg(F.count(F.lit(1)).alias("logged_failures"))
    return spark.read.parquet(f"{path}/dq_summary").join(failed, "invocation_id", "left").select(
        "invocation_id", "built_at", "models_built", "tests_run", "tests_passed", "tests_warned", "pass_pct",
        F.coalesce("logged_failures", F.lit(0).cast("long")).alias("logged_failures"))
