import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.asof import asof_left_join, time_cuts
from starloom.operators.skew import key_salts, salted_join

V1, V2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def dims(spark):
    return spark.createDataFrame(
        [("sk1", 1, V1, V2), ("sk2", 1, V2, None), ("sk3", 2, V1, None)],
        "customer_sk string, customer_id long, valid_from timestamp, valid_to timestamp",
    )


def test_half_open_bounds(spark):
    ev = spark.createDataFrame(
        [(10, 1, V2), (11, 1, V2 - dt.timedelta(microseconds=1)), (12, 1, V1 - dt.timedelta(days=1)), (13, 3, V2)],
        "order_id long, customer_id long, ordered_at timestamp",
    )
    out = asof_left_join(ev, dims(spark), "customer_id", "ordered_at", ["customer_sk"])
    got = {r.order_id: r.customer_sk for r in out.collect()}
    assert got == {10: "sk2", 11: "sk1", 12: None, 13: None}


def hot_orders(spark):
    """2,000 orders: two thirds of customer 1, the rest of customer 2 and of one-off customers."""
    customer = F.when(F.col("id") % 3 < 2, F.lit(1)).when(F.col("id") % 6 == 2, F.lit(2)).otherwise(F.col("id")).cast("long")
    return spark.range(0, 2000).select(
        F.col("id").alias("order_id"), customer.alias("customer_id"),
        (F.lit(V1) + F.make_interval(days=(F.col("id") % 300).cast("int"))).alias("ordered_at"))


def test_salts_follow_the_rows_of_each_key(spark):
    got = {r._salt_key: r._salts for r in key_salts(hot_orders(spark), "customer_id", 100).collect()}
    assert got == {1: 14, 2: 4}
    assert key_salts(hot_orders(spark), "customer_id").count() == 0


def test_hot_keys_are_cut_at_quantiles_of_their_times(spark):
    got = {r._cut_key: r._cuts for r in time_cuts(hot_orders(spark), "customer_id", "ordered_at", 100).collect()}
    assert {k: len(v) for k, v in got.items()} == {1: 13, 2: 3}
    for k, cuts in got.items():
        assert cuts == sorted(set(cuts))
        times = sorted(r.ordered_at for r in hot_orders(spark).where(f"customer_id = {k}").collect())
        sizes = [sum(a <= t < b for t in times) for a, b in zip([V1, *cuts], [*cuts, dt.datetime(2100, 1, 1)])]
        assert sum(sizes) == len(times) and max(sizes) < 2 * 100
    assert time_cuts(hot_orders(spark), "customer_id", "ordered_at").count() == 0


def test_no_task_gets_a_whole_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = asof_left_join(hot_orders(spark), dims(spark), "customer_id", "ordered_at", ["customer_sk"], rows_per_task=50)
        parts = out.where("customer_id = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) >= 5 and max(r["count"] for r in parts) < 700


def wide_history(spark, versions=400):
    """400 versions of each of 3 keys, every tenth one followed by a gap; starts shared by a version of no length."""
    rows = []
    for k in range(3):
        for i in range(versions):
            start = V1 + dt.timedelta(hours=i)
            rows.append((f"k{k}v{i}", k, start, start + dt.timedelta(minutes=30) if i % 10 == 0 else start + dt.timedelta(hours=1)))
        rows.append((f"k{k}empty", k, V1 + dt.timedelta(hours=5), V1 + dt.timedelta(hours=5)))
    return spark.createDataFrame(rows, "sk string, k long, valid_from timestamp, valid_to timestamp")


def test_long_histories_with_gaps_equal_the_range_join(spark):
    ev = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 4).alias("k"),
                                  F.when(F.col("id") % 70 == 1, None).otherwise(
                                      F.lit(V1) + F.make_dt_interval(mins=(F.col("id") * 7 % 25_000).cast("int"))).alias("t"))
    v = wide_history(spark)
    want = ev.join(v.withColumnRenamed("k", "vk"), (F.col("k") == F.col("vk")) & (F.col("t") >= F.col("valid_from")) & (F.col("t") < F.col("valid_to")), "left")
    want = sorted((r.id, r.sk or "") for r in want.collect())
    assert len(want) == 3000 and len({s for _, s in want}) > 500
    for rows_per_task in (None, 10, 90, 100_000):
        got = asof_left_join(ev, v, "k", "t", ["sk"], rows_per_task=rows_per_task)
        assert got.columns == ["id", "k", "t", "sk"]
        assert sorted((r.id, r.sk or "") for r in got.collect()) == want


def test_the_plan_has_no_range_join(spark):
    plan = asof_left_join(hot_orders(spark), dims(spark), "customer_id", "ordered_at", ["customer_sk"])._jdf.queryExecution().executedPlan().toString()
    assert "valid_from" in plan and "SortMergeJoin" not in plan.replace("_cut_key", "")


def test_several_hot_keys_split_equal_the_plain_join(spark):
    ev = hot_orders(spark)
    rows = lambda df: sorted((r.order_id, r.customer_sk or "") for r in df.select("order_id", "customer_sk").collect())
    plain = rows(asof_left_join(ev, dims(spark), "customer_id", "ordered_at", ["customer_sk"], rows_per_task=None))
    split = asof_left_join(ev, dims(spark), "customer_id", "ordered_at", ["customer_sk"], rows_per_task=100)
    assert split.columns == [*ev.columns, "customer_sk"] and rows(split) == plain and len(plain) == 2000


def test_every_join_type_that_keeps_left_rows(spark):
    ev, right = hot_orders(spark), spark.createDataFrame([(1, "a"), (1, "b"), (7, "c")], "k long, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = ev.join(right, F.col("customer_id") == F.col("k"), how)
        got = salted_join(ev, right, "customer_id", "k", ["order_id"], how, rows_per_task=50)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), how
