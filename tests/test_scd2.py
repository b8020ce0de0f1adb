import datetime as dt

from starloom.operators.scd2 import snapshot

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 6, 1)
SCHEMA = "customer_id long, city string, updated_at timestamp"


def cur(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((r.customer_id, r.city, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect())


def test_new_key_opens_row(spark):
    h = snapshot(cur(spark, [(1, "a", T0)]), None, "customer_id")
    assert rows(h) == [(1, "a", T0, None)]


def test_newer_clock_closes_and_opens(spark):
    h1 = snapshot(cur(spark, [(1, "a", T0)]), None, "customer_id")
    h2 = snapshot(cur(spark, [(1, "b", T1)]), h1, "customer_id")
    assert rows(h2) == [(1, "a", T0, T1), (1, "b", T1, None)]


def test_same_or_older_clock_is_ignored(spark):
    h1 = snapshot(cur(spark, [(1, "a", T1)]), None, "customer_id")
    h2 = snapshot(cur(spark, [(1, "changed", T1)]), h1, "customer_id")
    h3 = snapshot(cur(spark, [(1, "older", T0)]), h1, "customer_id")
    assert rows(h2) == rows(h1) == rows(h3)


def test_rerun_is_noop_and_vanished_key_stays_open(spark):
    c = cur(spark, [(1, "a", T0), (2, "b", T0)])
    h1 = snapshot(c, None, "customer_id")
    assert rows(snapshot(c, h1, "customer_id")) == rows(h1)
    h2 = snapshot(cur(spark, [(1, "a", T0)]), h1, "customer_id")
    assert (2, "b", T0, None) in rows(h2)


def test_closed_rows_never_change(spark):
    h1 = snapshot(cur(spark, [(1, "a", T0)]), None, "customer_id")
    h2 = snapshot(cur(spark, [(1, "b", T1)]), h1, "customer_id")
    t2 = dt.datetime(2025, 1, 1)
    h3 = snapshot(cur(spark, [(1, "c", t2)]), h2, "customer_id")
    assert rows(h3) == [(1, "a", T0, T1), (1, "b", T1, t2), (1, "c", t2, None)]
