"""Governance: the masked analyst view and the PII inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import hash_pii, mask_email, mask_phone


def dim_customer_restricted(dim_customer: DataFrame) -> DataFrame:
    """Same rows as dim_customer; names and address dropped, email/phone masked."""
    return dim_customer.select(
        "customer_sk", "customer_id",
        hash_pii("email").alias("email_hash"),
        mask_email("email").alias("email_masked"),
        mask_phone("phone").alias("phone_masked"),
        "city", "state", "segment", "signup_date", "valid_from", "valid_to", "is_current",
    )


def distinct_people(restricted: DataFrame) -> DataFrame:
    """People counted through the hashed email (what the hash is for)."""
    return restricted.agg(
        F.countDistinct("email_hash").alias("people"),
        F.count(F.lit(1)).alias("customer_versions"),
        F.countDistinct("customer_id").alias("customers"),
    )


# Registers of a people sketch (2^14), and the relative error that an estimate keeps within: four standard errors, 1.04 / sqrt(2^14) each.
SKETCH_LG = 14
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH_LG / 2)


def people_sketches(restricted: DataFrame) -> DataFrame:
    """(signup_date, people_sketch, versions): a mergeable sketch of the hashed emails of each day.

    A table of a row a day, from which people of any set of days are estimated without reading customers again.
    """
    return restricted.groupBy("signup_date").agg(
        F.hll_sketch_agg("email_hash", SKETCH_LG).alias("people_sketch"), F.count(F.lit(1)).alias("versions"))


def people_estimate(sketches: DataFrame, *by: str) -> DataFrame:
    """(*by, estimate): people in each group of days, from merged sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("people_sketch")).alias("estimate"))


def people_by_month(restricted: DataFrame, sketches: DataFrame) -> DataFrame:
    """(signup_month, people, estimate_in_bounds): exact people of each sign-up month and of all, and whether the merged sketches agree."""
    month = F.date_format("signup_date", "yyyy-MM").alias("signup_month")
    label = lambda df: df.withColumn("signup_month", F.coalesce("signup_month", F.lit("all")))
    exact = label(restricted.select(month, "email_hash").rollup("signup_month").agg(F.countDistinct("email_hash").alias("people")))
    merged = sketches.select(month, "people_sketch").rollup("signup_month").agg(
        F.hll_sketch_estimate(F.hll_union_agg("people_sketch")).alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("people")) <= SKETCH_ERROR * F.col("people") + 1
    return exact.join(label(merged), "signup_month").select("signup_month", "people", near.alias("estimate_in_bounds"))


INVENTORY_SCHEMA = T.StructType([
    T.StructField("schema_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("non_null_values", T.LongType()),
])


def pii_inventory(spark: SparkSession, models: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """The inventory, read from the models' column metadata, with how many
    values each tagged column holds (one aggregation pass per model)."""
    parts = []
    for schema_name, model_name, df in models:
        cols = [f.name for f in df.schema.fields if f.metadata.get("pii")]
        if not cols:
            continue
        counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
        pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(counts.select(
            F.lit(schema_name).alias("schema_name"), F.lit(model_name).alias("model_name"),
            F.expr(f"stack({len(cols)}, {pairs}) as (column_name, non_null_values)"),
        ))
    if not parts:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
