"""Published versions: a crash at any step shows the old or the new table, never a mix."""
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import history, publish
from starloom.operators.incremental import SchemaDrift
from starloom.operators.scd2 import snapshot
from starloom.session import scratch_path
from starloom.sources import fs

SCHEMA = "k long, v string, month string"


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture()
def table(spark):
    path = scratch_path(spark, "t_publish")
    publish.create(spark, spark.createDataFrame([(1, "a", "01"), (2, "b", "01"), (3, "c", "02"), (4, "d", "03")], SCHEMA), path, "month")
    return path


OLD = Counter([(1, "a", "01"), (2, "b", "01"), (3, "c", "02"), (4, "d", "03")])
NEW = [(2, "B", "02"), (4, "D", "04"), (5, "e", "01"), (6, "f", None)]
AFTER = Counter([(1, "a", "01"), (3, "c", "02"), *NEW])


def test_delete_and_insert_moves_keys_between_partitions(spark, table):
    untouched = publish.resolve(spark, table)
    out = publish.delete_insert(spark, spark.createDataFrame(NEW, SCHEMA), table, "k")
    assert out == {"mode": "delete+insert", "touched_partitions": 5, "version": 2}
    assert rows(publish.read(spark, table)) == AFTER
    assert "03" not in publish.resolve(spark, table).parts  # its only row moved away
    assert rows(publish.read(spark, table, 1)) == rows(publish.read(spark, table, untouched)) == OLD


def test_untouched_partitions_keep_their_files(spark, table):
    before = publish.resolve(spark, table).parts
    publish.delete_insert(spark, spark.createDataFrame([(7, "g", "02")], SCHEMA), table, "k")
    after = publish.resolve(spark, table).parts
    assert {p for p in before if before[p] != after[p]} == {"02"}
    assert publish.delete_insert(spark, spark.createDataFrame([], SCHEMA), table, "k")["mode"] == "noop"
    assert publish.resolve(spark, table).number == 2


@pytest.mark.parametrize("step", ["write_load", "write_text", "rename_new"])
@pytest.mark.parametrize("done", [False, True])
def test_a_crash_at_each_step_shows_old_or_new(spark, table, monkeypatch, step, done):
    """The step fails before or after its effect."""
    owner = publish if step == "write_load" else publish.fs
    name = "_write_load" if step == "write_load" else step
    real = getattr(owner, name)

    def crash(*args):
        if done:
            real(*args)
        raise KeyboardInterrupt

    new = spark.createDataFrame(NEW, SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(owner, name, crash)
        with pytest.raises(KeyboardInterrupt):
            publish.delete_insert(spark, new, table, "k")
    published = step == "rename_new" and done
    assert rows(publish.read(spark, table)) == (AFTER if published else OLD)
    publish.delete_insert(spark, new, table, "k")  # the retry
    assert rows(publish.read(spark, table)) == AFTER


def test_an_open_reader_keeps_its_version(spark, table):
    reader = publish.read(spark, table)
    publish.delete_insert(spark, spark.createDataFrame(NEW, SCHEMA), table, "k")
    assert rows(reader) == OLD


def test_the_second_of_two_loads_from_one_version_fails(spark, table):
    base = publish.resolve(spark, table)
    one = spark.createDataFrame([(8, "x", "02"), (3, "c", "02")], SCHEMA)
    publish.replace(spark, table, base, ["02"], one)
    with pytest.raises(publish.Conflict):
        publish.replace(spark, table, base, ["01"], spark.createDataFrame([(9, "y", "01")], SCHEMA))
    assert rows(publish.read(spark, table)) == OLD + Counter([(8, "x", "02")])
    assert [n for n in fs.children(spark, f"{table}/versions") if n.startswith("_")] == []


def test_schema_changes_and_missing_tables_fail(spark, table):
    with pytest.raises(SchemaDrift):
        publish.delete_insert(spark, spark.createDataFrame([(1, 2, "01")], "k long, v long, month string"), table, "k")
    with pytest.raises(ValueError):
        publish.read(spark, scratch_path(spark, "t_none"))
    with pytest.raises(ValueError):
        publish.read(spark, table, 9)


def test_expire_removes_what_no_kept_version_names(spark, table):
    for v in ("p", "q", "r"):
        publish.delete_insert(spark, spark.createDataFrame([(1, v, "01")], SCHEMA), table, "k")
    publish._write_load(spark, spark.createDataFrame(NEW, SCHEMA), table, "month")  # a load that failed
    now = rows(publish.read(spark, table))
    assert publish.expire(spark, table, keep=2) == 2
    assert rows(publish.read(spark, table)) == now
    assert rows(publish.read(spark, table, 3)) == Counter([(1, "q", "01"), (2, "b", "01"), (3, "c", "02"), (4, "d", "03")])
    assert publish.expire(spark, table, keep=2) == 0


def test_pruning_and_empty_tables(spark, table):
    plan = publish.read(spark, table).where("month = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:80]
    empty = scratch_path(spark, "t_empty")
    publish.create(spark, spark.createDataFrame([], SCHEMA), empty, "month")
    assert publish.read(spark, empty).count() == 0
    publish.delete_insert(spark, spark.createDataFrame(NEW, SCHEMA), empty, "k")
    assert rows(publish.read(spark, empty)) == Counter(NEW)


# history ---------------------------------------------------------------------
T0 = dt.datetime(2024, 1, 1)
CUSTOMER = "customer_id long, city string, updated_at timestamp"


def batch(spark, rows_):
    return spark.createDataFrame([(k, c, T0 + dt.timedelta(days=d)) for k, c, d in rows_], CUSTOMER)


def test_history_runs_equal_the_whole_rewrite(spark):
    path, whole = scratch_path(spark, "t_history"), None
    base = [(k, "a", 0) for k in range(200)]
    runs = [base, base[3:] + [(1, "b", 5), (2, "late", -1), (900, "new", 2)], base, [(1, "c", 9), (1000, "z", 1)], []]
    expected = [{"mode": "create"}, {"mode": "changes", "opened": 2, "closed": 1, "buckets": 2},
                {"mode": "noop", "opened": 0, "closed": 0, "buckets": 0},
                {"mode": "changes", "opened": 2, "closed": 1, "buckets": 2}, {"mode": "noop", "opened": 0, "closed": 0, "buckets": 0}]
    for run, said in zip(runs, expected):
        cur = batch(spark, run)
        whole = snapshot(cur, whole, "customer_id")
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        assert history.run_snapshot(spark, cur, path, "customer_id") == said
        got = history.read_history(spark, path)
        assert got.columns == whole.columns and rows(got) == rows(whole)


def test_what_a_run_writes_follows_its_changes(spark):
    path = scratch_path(spark, "t_history")
    base = [(k, "a", 0) for k in range(5000)]
    history.run_snapshot(spark, batch(spark, base), path, "customer_id")

    def files():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()

    first = files()
    history.run_snapshot(spark, batch(spark, base), path, "customer_id")
    assert files() == first
    history.run_snapshot(spark, batch(spark, [*base[1:], (0, "moved", 3)]), path, "customer_id")
    assert files() - first < first / 4
    closed = publish.resolve(spark, path).parts[history.CLOSED]
    history.run_snapshot(spark, batch(spark, [*base[1:], (0, "moved on", 4)]), path, "customer_id")
    assert publish.resolve(spark, path).parts[history.CLOSED][:1] == closed  # appended, not rewritten
    got = history.read_history(spark, path)
    assert got.where("customer_id = 0").count() == 3 and got.where(F.col("dbt_valid_to").isNull()).count() == 5000
