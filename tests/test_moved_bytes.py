"""What tables and shuffles hold of hex digests, and how often the suite counts a column's keys."""

import hashlib

from pyspark.sql import functions as F

from starloom.functions import packed_text, unpacked_text
from starloom.operators import publish
from starloom.operators.incremental import delete_insert
from starloom.operators.quality import Check, run_checks
from starloom.plans import marts
from starloom.plans.warehouse import Warehouse
from starloom.session import ADVISORY_SIZE, INITIAL_PARTITIONS, scratch_path, size_shuffles


def md5(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def codecs(folder):
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{folder.removeprefix('file://').removeprefix('file:')}/**/*.parquet", recursive=True)
    found = [pq.ParquetFile(f).metadata for f in files]
    return {m.row_group(g).column(0).compression for m in found for g in range(m.num_row_groups)}


def test_packed_text_loses_nothing(spark):
    texts = [None, "", md5(1), md5(1).upper(), md5(2)[:31], md5(2) + "0", "g" * 32, "é" * 16, "a" * 16, "\x00" * 15, " " + md5(3)[1:]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", packed_text("t").alias("p")).select("t", "p", unpacked_text("p").alias("u")).collect()
    assert [r.u for r in got] == texts
    assert len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert [len(r.p) for r in got if r.t == md5(1)] == [16]


def test_warehouse_and_published_tables_are_compressed(spark):
    wh = Warehouse(spark, "/root/testdata/sf0.001", persist=True)
    wh._written("t_codec", spark.range(10).withColumn("k", F.md5(F.col("id").cast("string"))))
    assert codecs(wh.paths["t_codec"]) == {"ZSTD"}
    path = scratch_path(spark, "t_codec")
    publish.create(spark, spark.createDataFrame([(1, "a", "01")], "k long, v string, month string"), path, "month")
    publish.delete_insert(spark, spark.createDataFrame([(2, "b", "02")], "k long, v string, month string"), path, "k")
    assert codecs(path) == {"ZSTD"}


def test_digests_move_as_bytes(spark):
    orders = spark.createDataFrame([(i, i % 7, md5(i % 7) if i % 5 else None, None) for i in range(40)],
                                   "order_id long, customer_id long, customer_sk string, ordered_at timestamp")
    orders = orders.withColumn("ordered_at", F.timestamp_seconds(F.col("order_id") * 86400))
    lines = spark.createDataFrame([(md5(f"l{i}") if i % 3 else f"line {i}", i % 50, i, i % 4, 1, 2, 0, 2) for i in range(200)],
                                  "order_item_id string, order_id long, line_number long, product_id long, quantity long, unit_price long, discount long, line_total long")
    products = spark.createDataFrame([(md5(f"p{i}"), i) for i in range(3)], "product_sk string, product_id long")
    df = marts.fact_order_items(lines, orders, products)
    want = lines.join(orders, "order_id").join(products, "product_id", "left")
    cols = ["order_item_id", "order_id", "customer_sk", "product_sk"]
    assert sorted(map(str, df.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan.split("Join", 2)[-1]  # below the joins, so before rows move


def test_redelivered_rows_of_digest_keys(spark):
    schema = "k string, v long"
    target = spark.createDataFrame([(md5(1), 1), (md5(2), 2), ("x", 3), (None, 4), (md5(2), 5)], schema)
    new = spark.createDataFrame([(md5(2), 20), ("x", 30), (None, 40), (md5(9), 90)], schema)
    df = delete_insert(target, new, "k")
    assert sorted((r.v for r in df.collect())) == [1, 4, 20, 30, 40, 90]
    # The table itself stays where it is: what comes again is known and broadcast.
    assert "BroadcastHashJoin" in df._jdf.queryExecution().sparkPlan().toString()


def test_published_digests_stay_texts(spark):
    path = scratch_path(spark, "t_digests")
    schema = "k string, v string, month string"
    publish.create(spark, spark.createDataFrame([(md5(1), md5(7), "01"), (md5(2), None, "02"), ("x", "y", None)], schema), path, "month", ["k", "v"])
    publish.delete_insert(spark, spark.createDataFrame([(md5(2), md5(8), "03"), ("z", "", "01")], schema), path, "k", ["k", "v"])
    assert {tuple(r) for r in publish.read(spark, path).collect()} == {(md5(1), md5(7), "01"), ("x", "y", None), (md5(2), md5(8), "03"), ("z", "", "01")}


def test_keys_of_a_column_are_counted_once(spark):
    child = spark.createDataFrame([(md5(i % 9), i % 4, i % 3) for i in range(20)], "sk string, a int, b long")
    parent = spark.createDataFrame([(md5(i),) for i in range(5)], "p string")
    checks = [Check("c", "sk", "unique"), Check("c", "sk", "relationships", to_model="d", to_column="p"),
              Check("d", "p", "relationships", to_model="c", to_column="sk"), Check("d", "p", "unique"), Check("c", "a,b", "unique")]
    df = run_checks({"c": child, "d": parent}, checks)
    assert [(r.test_type, r.failures) for r in df.collect()] == [
        ("unique", 9), ("relationships", 8), ("relationships", 0), ("unique", 0), ("unique", 8)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The texts and pairs of (test, key, child, parent) that every check emitted before are gone.
    assert "to_json" not in plan.lower() and "structstojson" not in plan.lower()
    assert plan.count("Aggregate [k0") == 2  # one for sk and p together, one for the pairs


def test_lines_join_only_odd_products(spark):
    orders = spark.createDataFrame([(1, "a"), (2, None)], "order_id long, customer_sk string").withColumn("ordered_at", F.lit("2024-01-01").cast("timestamp"))
    ids = [1, 2, 3, 3, None, 9, 4, 5, 6]
    lines = spark.createDataFrame([(md5(f"l{i}"), i % 3, i, p, 1, 2, 0, 2) for i, p in enumerate(ids * 3)],
                                  "order_item_id string, order_id long, line_number long, product_id long, quantity long, unit_price long, discount long, line_total long")
    # Twice, by another key, without a key, with the key of another product, and NULL ids; 9 is missing.
    products = spark.createDataFrame([(md5(1), 1), (md5(2), 2), (md5(2), 2), ("x", 3), (None, 4), (md5(1), 5), (md5(6), 6), ("y", 6), (md5(""), None), (md5(7), 7)],
                                     "product_sk string, product_id long")
    odd = marts.odd_products(lines, products)
    found = sorted((r.product_id, r.product_sk or "") for r in odd.collect())
    assert found == sorted([(2, md5(2)), (2, md5(2)), (3, "x"), (4, ""), (5, md5(1)), (6, md5(6)), (6, "y"), (9, "")])
    want = marts.fact_order_items(lines, orders, products)
    got = marts.fact_order_items(lines, orders, products, odd)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lines_of_a_written_warehouse_move_once(spark):
    """The dimension is too large to be broadcast: lines went to their orders and then to their products."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "15000")
    try:
        wh = Warehouse(spark, "/root/testdata/sf0.001", persist=True)
        wh.dim_product, wh.odd_products, wh.orders_with_customer
        plans = []
        write = wh._written
        wh._written = lambda name, df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or write(name, df)
        wh.fact_order_items
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(plans) == 1 and plans[0].count("SortMergeJoin") + plans[0].count("ShuffledHashJoin") == 1 and plans[0].count("BroadcastHashJoin") == 1
    assert wh.odd_products.count() == 0


def test_written_digests_are_bytes(spark):
    wh = Warehouse(spark, "/root/testdata/sf0.001", persist=True)
    for name, digests in (("raw_order_items", ["order_item_id"]), ("fact_orders", ["customer_sk"]), ("fact_order_items", ["order_item_id", "customer_sk", "product_sk"])):
        seen, plain = getattr(wh, name), getattr(Warehouse(spark, "/root/testdata/sf0.001"), name)
        assert {c: spark.read.parquet(wh.paths[name]).schema[c].dataType.typeName() for c in digests} == dict.fromkeys(digests, "binary")
        assert seen.dtypes == plain.dtypes
        assert seen.exceptAll(plain).isEmpty() and plain.exceptAll(seen).isEmpty()


def test_shuffles_grow_with_the_input(spark):
    s = spark.newSession()
    size_shuffles(s, 1 << 20)
    assert s.conf.get(INITIAL_PARTITIONS, None) is None  # the caller's partitions
    assert s.conf.get(ADVISORY_SIZE) == f"{16 << 20}b"
    size_shuffles(s, 6 << 30)
    assert s.conf.get(INITIAL_PARTITIONS) == "768"
    size_shuffles(s, 1 << 30)
    assert s.conf.get(INITIAL_PARTITIONS) == "768"
    s.conf.set(ADVISORY_SIZE, "4m")
    size_shuffles(s, 1 << 40)
    assert (s.conf.get(INITIAL_PARTITIONS), s.conf.get(ADVISORY_SIZE)) == ("4000", "4m")
