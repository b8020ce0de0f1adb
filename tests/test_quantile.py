"""Exact medians by counted ranges."""
import random
import statistics

import pytest

from starloom.operators import quantile


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    r = quantile.spread_of(df, "v", "x").first()
    some = [v for v in values if v is not None]
    if not some:
        assert tuple(r) == (None, None, None, None)
        return
    assert (r.rows, r.x_min_ms, r.x_max_ms) == (len(some), min(some), max(some))
    assert r.x_median_ms == statistics.median(some)


@pytest.mark.parametrize("values", [[], [None], [5], [5, None, 6], [3] * 7, [-4, 9, -4, 2], list(range(2000, -1, -1)),
                                    [7] * 500 + [0, 10**12], [-(2**40), 2**40, 1, 2]])
def test_small_tables(spark, values):
    check(spark, values)


def test_wide_values_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(quantile, "BINS", 4)
    rng = random.Random(2)
    check(spark, [rng.randrange(-(10**6), 10**6) for _ in range(501)] + [13] * 300)


def test_ranks_over_the_whole_range_of_64_bits(spark):
    values = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**62, 2**63 - 1]
    counted = quantile.counted_values(spark.createDataFrame([(v,) for v in values], "v long"), "v")
    got = quantile.values_at_ranks(counted, [1, 2, 3, 4, 5, 6, 7], values[0], values[-1])
    assert [got[r] for r in range(1, 8)] == values


def test_no_task_orders_the_table(spark):
    from starloom.plans.warehouse import Warehouse

    out = Warehouse(spark, "/root/testdata/sf0.001").latency_summary
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
