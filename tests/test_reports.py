import datetime as dt

from pyspark.sql import functions as F

from starloom.plans import reports

T0 = dt.datetime(2024, 1, 1, 12, 0)
LOG = ("job_id long, creation_time timestamp, end_time timestamp, job_type string, total_bytes_processed long, "
       "total_bytes_billed long, total_slot_ms long, labels array<struct<key:string,value:string>>")


def log(spark):
    lab = lambda v: [("dbt_invocation_id", v), ("other", "x")]
    rows = [
        (1, T0, T0 + dt.timedelta(seconds=5), "QUERY", 100, 2**30, 1500, lab("a")),
        (2, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=1, seconds=3), "QUERY", 50, 2**29, 250, lab("a")),
        (3, T0, T0, "LOAD", 7, 7, 7, lab("a")),                       # not a query job
        (4, T0, T0, "QUERY", 9, 9, 9, None),                          # no labels
        (5, T0, T0, "QUERY", 9, 9, 9, [("other", "a")]),             # no invocation label
        (6, T0 + dt.timedelta(hours=3), T0 + dt.timedelta(hours=3), "QUERY", 1, 1, 1, lab("b")),
    ]
    return spark.createDataFrame(rows, LOG)


def test_rollup_per_invocation(spark):
    got = {r.invocation_id: r for r in reports.job_log_rollup(log(spark)).collect()}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a.jobs, a.bytes_billed, a.bytes_processed, a.slot_ms) == (2, 2**30 + 2**29, 150, 1750)
    assert a.first_job == T0 and a.last_job == T0 + dt.timedelta(hours=1, seconds=3)
    assert a.gib_billed == 1.5 and a.slot_seconds == 1.8  # 1.75 rounds half up


def test_rollup_one_invocation_with_horizon(spark):
    one = reports.job_log_rollup(log(spark), invocation="a").collect()
    assert [r.invocation_id for r in one] == ["a"]
    recent = reports.job_log_rollup(log(spark), invocation="a", since=T0 + dt.timedelta(minutes=30)).collect()
    assert [(r.invocation_id, r.jobs) for r in recent] == [("a", 1)]
    assert reports.job_log_rollup(log(spark), invocation="zzz").count() == 0


def test_first_n_is_ordered_top_k(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("k"))
    assert [r.k for r in reports.first_n(df, 5, ["k"]).collect()] == [0, 1, 2, 3, 4]
    assert reports.first_n(df, 0, ["k"]).count() == 100


def test_contract_check_reports_a_drifted_mart(spark):
    from pyspark.sql import functions as F

    from starloom.plans import reports
    from starloom.plans.warehouse import Warehouse

    wh = Warehouse(spark, "/root/testdata/sf0.001")
    models = {"dim_date": wh.dim_date, "dim_product": wh.dim_product.withColumn("list_price", F.col("list_price").cast("double")),
              "dim_customer": wh.dim_customer.drop("phone"), "fact_orders": wh.fact_orders, "fact_order_items": wh.fact_order_items}
    got = {r.model: (r.status, r.message) for r in reports.contract_check(spark, models).collect()}
    assert {m: s for m, (s, _) in got.items()} == {
        "dim_date": "pass", "dim_product": "fail", "dim_customer": "fail", "fact_orders": "pass", "fact_order_items": "pass"}
    assert "list_price" in got["dim_product"][1] and got["dim_date"][1] == ""


def test_new_input_files_make_new_tables(spark):
    import os
    import shutil

    from starloom.plans.catalog import built_warehouse
    from starloom.session import scratch_path

    path = scratch_path(spark, "t_inputs")
    shutil.copytree("/root/testdata/sf0.001", path)
    first = built_warehouse(spark, path)
    assert built_warehouse(spark, path) is first
    before = first.raw_orders.count()
    spark.read.parquet(f"{path}/orders.parquet").limit(10).write.parquet(f"{path}/fewer")
    part = [f for f in os.listdir(f"{path}/fewer") if f.endswith(".parquet")][0]
    os.replace(f"{path}/fewer/{part}", f"{path}/orders.parquet")
    crc = f"{path}/.orders.parquet.crc"
    assert not os.path.exists(crc)
    second = built_warehouse(spark, path)
    assert second is not first and second.raw_orders.count() == 10 < before == first.raw_orders.count()


def test_merged_daily_sketches_estimate_people(spark):
    from pyspark.sql import functions as F

    from starloom.plans import governance

    people = spark.range(60_000).select(
        F.md5((F.col("id") % 40_000).cast("string")).alias("email_hash"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("signup_date"))
    sketches = governance.people_sketches(people)
    assert sketches.count() == 90
    exact = {r.signup_month: r.people for r in governance.people_by_month(people, sketches).collect()}
    assert set(exact) == {"2024-01", "2024-02", "2024-03", "all"} and exact["all"] == 40_000
    assert all(r.estimate_in_bounds for r in governance.people_by_month(people, sketches).collect())
    estimate = governance.people_estimate(sketches).first().estimate
    assert abs(estimate - 40_000) <= governance.SKETCH_ERROR * 40_000
    wrong = sketches.where("signup_date < '2024-01-15'")  # days missing from the table are noticed
    assert not [r for r in governance.people_by_month(people, wrong).collect() if r.signup_month == "all"][0].estimate_in_bounds
