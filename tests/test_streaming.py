import json
import os

from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.streaming import order_metrics as om


def event(order_id, status, t, total=10.0, items=2):
    stamp = f"2024-01-01T{t}.000Z"
    return json.dumps({"order_id": order_id, "customer_id": 1, "order_total": total, "item_count": items,
                       "status": status, "event_time": stamp, "produced_at": stamp})


def write_batches(spark, batches):
    d = scratch_path(spark, "t_stream_src")
    os.makedirs(d)
    for i, lines in enumerate(batches):
        p = os.path.join(d, f"part-{i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return d


def run(spark, batches):
    src = om.json_dir_event_source(spark, write_batches(spark, batches), max_files_per_trigger=1)
    q, sink = om.start(spark, src)
    assert q.awaitTermination(300)
    assert q.exception() is None
    return sorted((r.window_start.strftime("%H:%M"), r.order_count, r.revenue, r.avg_basket_size, r.latency_ms >= 0)
                  for r in om.read_sink(spark, sink).collect())


def test_heartbeats_close_window_and_are_not_counted(spark):
    got = run(spark, [[event(1, "completed", "00:00:10")], [event(-1, "tail", "00:01:30", 0.0, 0)],
                      [event(-2, "tail", "00:01:31", 0.0, 0)]])
    assert got == [("00:00", 1, 10.0, 2.0, True)]


def test_last_window_stays_open_without_later_events(spark):
    got = run(spark, [[event(1, "completed", "00:00:10"), event(2, "completed", "00:00:59.5".replace(".5", ""))]])
    assert got == []  # watermark 00:00:57 < window end 00:01:00


def test_late_row_two_batches_behind_is_dropped(spark):
    got = run(spark, [[event(1, "completed", "00:00:10")], [event(-1, "tail", "00:01:30", 0.0, 0)],
                      [event(-2, "tail", "00:01:31", 0.0, 0)], [event(-3, "tail", "00:01:32", 0.0, 0)],
                      [event(3, "completed", "00:00:50", 5.0, 4)]])
    assert got == [("00:00", 1, 10.0, 2.0, True)]


def test_malformed_json_is_ignored(spark):
    got = run(spark, [["{bad", event(1, "completed", "00:00:10", 4.5, 3), "not json at all"],
                      [event(-1, "tail", "00:01:40", 0.0, 0)]])
    assert got == [("00:00", 1, 4.5, 3.0, True)]


def test_iso_forms_are_kept_and_malformed_events_are_counted(spark):
    from pyspark.sql import Observation

    forms = ["2024-01-01T00:00:10Z", "2024-01-01T00:00:10.5Z", "2024-01-01T00:00:10.123456Z", "2024-01-01T00:00:10.123456789Z",
             "2024-01-01T00:00:10", "2024-01-01T02:00:10.250+02:00"]
    lines = [json.dumps({"order_id": i, "status": "completed", "event_time": t, "produced_at": t}) for i, t in enumerate(forms)]
    raw = spark.createDataFrame([(x,) for x in [*lines, "{bad", '{"order_id": 9, "event_time": "soon"}']], "value string")
    seen = Observation("seen")
    got = om.parse_json_events(raw).observe(seen, F.count("*").alias("n")).collect()
    assert sorted(r.order_id for r in got) == list(range(6)) and seen.get["n"] == 6
    assert {r.event_time.replace(microsecond=0).strftime("%H:%M:%S") for r in got} == {"00:00:10"}
    d = write_batches(spark, [[*lines, "{bad"]])
    q, _ = om.start(spark, om.json_dir_event_source(spark, d))
    q.awaitTermination()
    counted = [p.observedMetrics["parsed_events"] for p in q.recentProgress if "parsed_events" in p.observedMetrics]
    assert sum(c.rows for c in counted) == 7 and sum(c.malformed for c in counted) == 1


def test_events_json_round_trip(spark):
    from starloom.sources.driver_tables import order_events

    ev = order_events(spark, "/root/testdata/sf0.001").limit(50)
    js = om.events_to_json(ev)
    back = om.parse_json_events(js)
    a = sorted((r.order_id, r.status, r.item_count) for r in ev.collect())
    b = sorted((r.order_id, r.status, r.item_count) for r in back.collect())
    assert a == b


def test_empty_sink_before_first_batch_then_landed(spark):
    from starloom.schemas import WINDOW_METRICS

    path = scratch_path(spark, "t_sink")
    assert not om.first_window_landed(spark, path)
    assert om.read_sink(spark, path).schema == WINDOW_METRICS
    src = om.json_dir_event_source(spark, write_batches(spark, [[event(1, "completed", "00:00:10")],
                                                                [event(-1, "tail", "00:01:30", 0.0, 0)]]), 1)
    q, sink = om.start(spark, src, sink_path=path)
    assert q.awaitTermination(300)
    assert om.first_window_landed(spark, path)
    om.reset_sink(spark, path)
    assert not om.first_window_landed(spark, path)


def test_event_time_comes_from_the_attribute(spark):
    stamp = "2024-01-01T00:00:10.000Z"
    body = lambda i, **kw: json.dumps({"order_id": i, "status": "completed", "order_total": 2.0, "item_count": 1,
                                       "event_time": "2031-01-01T00:00:00Z", "produced_at": stamp, **kw})
    rows = [(body(1), {"event_time": stamp}), (body(2), {"event_time": stamp, "other": "x"}), (body(3), {"other": "x"}), (body(4), None),
            (body(5), {"event_time": "soon"}), ("{bad", {"event_time": "2024-01-01T00:02:00Z"})]
    path = scratch_path(spark, "t_envelopes")
    spark.createDataFrame(rows, om.ENVELOPE).coalesce(1).write.parquet(path)
    q, sink = om.start(spark, om.envelope_event_source(spark, path))
    assert q.awaitTermination(300)
    got = [(r.window_start.strftime("%H:%M"), r.order_count, r.revenue) for r in om.read_sink(spark, sink).collect()]
    assert got == [("00:00", 2, 4.0)]  # closed by the message that has a time but no readable payload
    counted = [p.observedMetrics["parsed_events"] for p in q.recentProgress if "parsed_events" in p.observedMetrics]
    assert [sum(c[k] for c in counted) for k in ("rows", "untimed", "malformed")] == [6, 3, 1]


def test_envelopes_round_trip(spark):
    from starloom.sources.driver_tables import order_events

    ev = order_events(spark, "/root/testdata/sf0.001")
    back = om.parse_envelopes(om.events_to_envelopes(ev))
    assert back.columns == ["order_id", "customer_id", "order_total", "item_count", "status", "event_time", "produced_at"]
    ms = lambda df: sorted((r.order_id, r.event_time.replace(microsecond=r.event_time.microsecond // 1000 * 1000)) for r in df.collect())
    assert ms(back) == ms(ev)
