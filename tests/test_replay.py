"""Replays slice by slice, against a plain reading of the watermark rule."""
import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.streaming import replay as rp

DAY = dt.datetime(2024, 1, 1)
EVENTS = "order_id long, customer_id long, order_total double, item_count int, status string, event_time timestamp, slice int"


def brute(rows):
    """{window start: (orders, revenue, emitting slice)} of rows (id, customer, total, items, status, time, slice)."""
    minute = lambda t: t.replace(second=0, microsecond=0)
    windows, counts, done = {}, defaultdict(list), set()
    watermark = dt.datetime.min
    late = 0
    for number in sorted({r[6] for r in rows}):
        mine = [r for r in rows if r[6] == number]
        for r in mine:
            if minute(r[5]) + dt.timedelta(minutes=1) <= watermark:
                late += 1
            else:
                counts[minute(r[5])].append(r)
        newest = max(r[5] for r in mine)
        watermark = max(watermark, newest.replace(microsecond=newest.microsecond // 1000 * 1000) - dt.timedelta(seconds=2))
        for w in sorted(counts):
            if w not in done and w + dt.timedelta(minutes=1) <= watermark:
                done.add(w)
                orders = [r for r in counts[w] if r[4] == "completed"]
                if orders:
                    windows[w] = (len(orders), round(sum(r[2] for r in orders), 2), number)
    return windows, late


def collected(table):
    return {r.window_start: (r.order_count, r.revenue, r.emitted_at) for r in table.collect()}


def expected(windows):
    return {w: (n, total, rp.slice_clock(s, rp.EMIT_AFTER)) for w, (n, total, s) in windows.items()}


def at(days, seconds=0.0):
    return DAY + dt.timedelta(days=days, seconds=seconds)


def event(i, t, slice_, status="completed", customer=2):
    return (i, customer, 1.5 + i, 1, status, t, slice_)


def run(spark, rows, sources=None):
    return rp.windows_of_replay(spark.createDataFrame(rows, EVENTS), sources)


def test_late_rows_are_dropped_and_stamps_are_the_clocks(spark):
    rows = [event(1, at(0, 10), 0), event(2, at(3, 30), 0), event(3, at(0, 20), 1), event(4, at(3, 40), 1),
            event(5, at(8), 1), event(6, at(8, 70), 2, "tail"), event(7, at(8, 5), 3), event(8, at(2.9), 3)]
    want, late = brute(rows)
    assert late == 3
    sink = run(spark, rows)
    assert collected(sink) == expected(want)
    for r in sink.collect():
        assert r.loaded_at - r.emitted_at == dt.timedelta(seconds=rp.LOAD_AFTER - rp.EMIT_AFTER)
        assert r.latency_ms == (r.loaded_at - r.window_end) // dt.timedelta(milliseconds=1)


def test_heartbeats_close_what_silent_orders_leave_open(spark):
    orders = [event(1, at(0, 10), 0), event(2, at(1, 10), 0)]
    beats = [event(10 + i, at(7 * i, 30), i, "tail") for i in range(1, 4)]
    assert collected(run(spark, orders + beats)) == expected(brute(orders + beats)[0])
    assert sorted(collected(run(spark, orders))) == [at(0)]  # the last window stays open


def test_an_idle_source_holds_nothing_up_and_a_slow_one_is_late(spark):
    even = [event(2 * i, at(2 * i, 5), i, customer=2) for i in range(1, 5)]
    odd = [event(101, at(2, 6), 1, customer=1), event(103, at(2, 8), 3, customer=1), event(105, at(6, 9), 3, customer=1)]
    want, late = brute(even + odd)
    assert late == 1  # 103: its window closed while the source was idle in slice 2
    by_customer = [F.col("customer_id") % 2 == 0, F.col("customer_id") % 2 == 1]
    got = run(spark, even + odd, by_customer)
    assert collected(got) == expected(want)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"  # the caller's rule stays


def test_slices_and_clocks(spark):
    times = [at(-3), at(0), at(6.9), at(7), at(20.5), at(35)]
    got = spark.createDataFrame([(t,) for t in times], "t timestamp").select(rp.slice_of(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [0, 0, 0, 1, 2, 5]
    assert rp.slice_clock(2, 1.5) == at(21, 1.5)


def test_first_sighting_of_each_window_behind_the_horizon(spark):
    windows = [(at(d), at(d, 60), n, 5.0, 1.0, rp.slice_clock(s, rp.EMIT_AFTER), rp.slice_clock(s, rp.LOAD_AFTER), 0)
               for d, n, s in [(0, 2, 0), (1, 3, 0), (1.5, 0, 0), (8, 4, 1), (2, 9, 2), (33, 1, 5)]]
    from starloom.schemas import WINDOW_METRICS

    table = spark.createDataFrame(windows, WINDOW_METRICS)
    seen = rp.sightings(table)
    assert seen.count() == 18 and {r.slice for r in seen.collect()} == set(range(8))
    got = rp.first_sightings(seen, "2024-01-02 00:00:30").collect()
    assert [r.window_start for r in got] == [at(1), at(2), at(8), at(33)]  # sorted; neither empty nor before the horizon
    for r in got:
        s = {at(1): 0, at(2): 2, at(8): 1, at(33): 5}[r.window_start]
        assert r.loaded_at == rp.slice_clock(s, rp.LOAD_AFTER)
        assert r.latency_ms == (r.loaded_at - r.window_end) // dt.timedelta(milliseconds=1)


def test_a_retried_batch_replaces_its_output(spark):
    path = scratch_path(spark, "t_clocked")
    write = rp.clocked_sink(path, at(7), at(7, 1))
    df = spark.createDataFrame([(at(1), at(1, 60), 2, 3.0, 1.0)], "window_start timestamp, window_end timestamp, order_count long, revenue double, avg_basket_size double")
    write(df, 4)
    write(df, 4)
    from starloom.schemas import WINDOW_METRICS

    assert [tuple(r) for r in rp.read_table(spark, path, WINDOW_METRICS).collect()] == [
        (at(1), at(1, 60), 2, 3.0, 1.0, at(7), at(7, 1), 518_341_000)]
    assert rp.read_table(spark, scratch_path(spark, "t_none"), WINDOW_METRICS).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_the_registered_replay_drops_late_rows(spark, sf):
    from starloom.plans.catalog import QUERIES
    from starloom.sources.driver_tables import order_events

    rows = [tuple(r) for r in rp.with_late_arrivals(order_events(spark, sf)).select(*[c.split()[0] for c in EVENTS.split(", ")]).collect()]
    want, late = brute(rows)
    assert late > 5
    got = {r.window_start: r.order_count for r in QUERIES["stream_late_data"](spark, sf).collect()}
    assert got == {w: n for w, (n, _, _) in want.items()}
