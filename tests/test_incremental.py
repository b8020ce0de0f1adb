import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import publish
from starloom.operators.incremental import (
    SchemaDrift, delete_insert, greatest_in_files, high_water_mark, high_water_of_files, newer_than, newer_than_target,
)
from starloom.session import scratch_path

SCHEMA = "order_id long, ordered_at timestamp, amount long, order_month string"
D1, D2, D3 = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5), dt.datetime(2024, 3, 5)


def test_tie_with_high_water_mark_is_skipped(spark):
    target = spark.createDataFrame([(1, D1, 10, "2024-01"), (2, D2, 20, "2024-02")], SCHEMA)
    src = spark.createDataFrame([(2, D2, 99, "2024-02"), (3, D3, 30, "2024-03")], SCHEMA)
    mark = high_water_mark(target, "ordered_at")
    assert mark == D2
    assert [r.order_id for r in newer_than(src, "ordered_at", mark).collect()] == [3]
    assert [r.order_id for r in newer_than_target(src, "ordered_at", target).collect()] == [3]
    assert high_water_mark(None, "ordered_at") == dt.datetime(1900, 1, 1)


def test_replay_replaces_old_row(spark):
    target = spark.createDataFrame([(1, D1, 10, "2024-01"), (2, D1, 20, "2024-01")], SCHEMA)
    new = spark.createDataFrame([(2, D3, 21, "2024-03")], SCHEMA)
    out = sorted(tuple(r) for r in delete_insert(target, new, "order_id").collect())
    assert out == [(1, D1, 10, "2024-01"), (2, D3, 21, "2024-03")]


def test_schema_drift_fails(spark):
    target = spark.createDataFrame([(1, D1, 10, "2024-01")], SCHEMA)
    with pytest.raises(SchemaDrift):
        delete_insert(target, target.withColumn("extra", F.lit(1)), "order_id")
    with pytest.raises(SchemaDrift):
        delete_insert(target, target.withColumn("amount", F.col("amount").cast("string")), "order_id")


def test_missing_source_file_fails(spark):
    from pyspark.errors import AnalysisException

    from starloom.sources.driver_tables import raw_orders

    with pytest.raises(AnalysisException):
        raw_orders(spark, "/root/testdata/no-such-scale").count()


def stamped(spark, days):
    return spark.createDataFrame([(i, D1 + dt.timedelta(days=d), i, f"2024-0{1 + i % 3}") for i, d in enumerate(days)], SCHEMA)


def test_high_water_mark_comes_from_file_statistics(spark):
    path = scratch_path(spark, "t_footer")
    publish.create(spark, stamped(spark, [3, 400, 7, 1]), path, "order_month")
    assert publish.high_water(spark, path, "ordered_at") == D1 + dt.timedelta(days=400)
    publish.delete_insert(spark, stamped(spark, [2, 5]), path, "order_id")  # the row of the greatest time is replaced
    assert publish.high_water(spark, path, "ordered_at") == D1 + dt.timedelta(days=7)
    v = publish.resolve(spark, path)
    stored = T.StructType([f for f in v.schema.fields if f.name != "order_month"])
    asked = greatest_in_files(spark, publish._paths(path, v), stored, "ordered_at")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(ordered_at)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session stays as it was


def test_high_water_mark_without_statistics_scans_the_column(spark):
    path = scratch_path(spark, "t_footer")
    df = stamped(spark, [3, 40, 7])
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    assert high_water_of_files(spark, [path], df.schema, "ordered_at") == D1 + dt.timedelta(days=40)
    assert high_water_of_files(spark, [], df.schema, "ordered_at") == dt.datetime(1900, 1, 1)
    empty = scratch_path(spark, "t_footer")
    publish.create(spark, df.limit(0), empty, "order_month")
    assert publish.high_water(spark, empty, "ordered_at") == dt.datetime(1900, 1, 1)


def test_lines_of_a_large_order_keep_their_own_keys(spark):
    from starloom.sources import driver_tables

    path = scratch_path(spark, "t_lines")
    big = spark.range(2500).selectExpr(
        "CASE WHEN id < 1500 THEN 1L ELSE 2L END AS l_orderkey", "id AS l_partkey", "1L AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "10.0D AS l_extendedprice", "0.1D AS l_discount")
    big.write.parquet(f"{path}/lineitem.parquet")
    items = driver_tables.raw_order_items(spark, path)
    assert items.select("order_item_id").distinct().count() == 2500
    assert "Window" not in items._jdf.queryExecution().toString()
