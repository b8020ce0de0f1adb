import datetime as dt

from starloom.operators.quality import Check, run_checks, with_status
from starloom.plans import quality_suite as QS
from starloom.plans.reports import source_freshness


def failures(spark, models, checks):
    return {r.test_name: (r.failures, r.status) for r in with_status(run_checks(models, checks)).collect()}


def test_generic_tests_fail_on_bad_rows(spark):
    child = spark.createDataFrame([(1, "a", 10), (1, "x", None), (2, None, 11), (3, "y", 99), (None, "x", 10)],
                                  "k long, v string, p long")
    parent = spark.createDataFrame([(10,), (11,)], "p long")
    checks = [Check("c", "k", "unique"), Check("c", "k", "not_null"), Check("c", "v", "not_null"),
              Check("c", "v", "accepted_values", values=("a", "b")),
              Check("c", "p", "relationships", to_model="parent", to_column="p"),
              Check("c", "v", "accepted_values", values=("a", "x", "y"), severity="warn", name_override="ok_values")]
    got = failures(spark, {"c": child, "parent": parent}, checks)
    assert got["unique_c_k"] == (1, "fail")            # one duplicated value, NULL ignored
    assert got["not_null_c_k"] == (1, "fail")
    assert got["not_null_c_v"] == (1, "fail")
    assert got["accepted_values_c_v__a__b"] == (2, "fail")  # distinct x, y; NULL passes
    assert got["relationships_c_p__p__ref_parent_"] == (1, "fail")  # 99 is orphan, NULL passes
    assert got["ok_values"] == (0, "pass")


def test_scd2_gap_caught_by_stricter_check(spark):
    t1, t2, t3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    dim = spark.createDataFrame(
        [(1, t1, None, True), (1, t2, None, True), (2, t1, t3, False), (2, t3, None, True)],
        "customer_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    assert QS.scd2_versions_do_not_overlap(dim).count() == 0  # the chain test lets a NULL valid_to through
    assert [r.customer_id for r in QS.one_current_version(dim).collect()] == [1]
    bad = spark.createDataFrame([(1, t1, t3, False), (1, t2, None, True)],
                                "customer_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    assert QS.scd2_versions_do_not_overlap(bad).count() == 1


def test_no_raw_pii(spark):
    r = spark.createDataFrame([("s1", "a***@x.com", "+1-200-***-****"), ("s2", "ab@x.com", "+1-200-***-****"),
                               ("s3", "a***@x.com", "+1-200-555-1234")],
                              "customer_sk string, email_masked string, phone_masked string")
    assert sorted(x.customer_sk for x in QS.analyst_views_have_no_raw_pii(r).collect()) == ["s2", "s3"]


def test_freshness_levels(spark):
    now = "2026-01-10 00:00:00"
    mk = lambda h: spark.createDataFrame([(dt.datetime(2026, 1, 10) - dt.timedelta(hours=h),)], "_loaded_at timestamp")
    res = source_freshness({"a": ("raw", mk(23), "_loaded_at"), "b": ("raw", mk(25), "_loaded_at"),
                            "c": ("raw", mk(73), "_loaded_at"), "d": ("stream", mk(80), "_loaded_at")}, now)
    got = {r.table_name: r.status for r in res.collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error", "d": "warn"}


def test_suite_declares_80_plus_singular():
    base = [c for c in QS.CHECKS if c.severity == "error"]
    assert len(base) == 80
    assert len(QS.SINGULAR) == 5


def test_pii_inventory_reads_tags_and_counts_values(spark):
    from pyspark.sql import functions as F

    from starloom.plans.governance import pii_inventory

    df = spark.createDataFrame([("a@x", "1"), (None, "2"), ("c@x", None)], "email string, city string")
    tagged = df.select(F.col("email").alias("email", metadata={"pii": True}), "city")
    got = [tuple(r) for r in pii_inventory(spark, [("s", "m", tagged), ("s", "none", df)]).collect()]
    assert got == [("s", "m", "email", 2)]
    # metadata is lost by a cast and must be re-attached
    assert pii_inventory(spark, [("s", "m", tagged.select(F.col("email").cast("string")))]).count() == 0
