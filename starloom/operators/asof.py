"""As-of join of events to a versioned dimension, by union and carry-forward.

Events and versions are one set of rows, ordered by (key, time): a version
stands at its start, an event at its time, and each event takes the last
version that stands before it. So a key costs events + versions, where an
equi join with a range as residual compares events x versions of the key.

Rows are dealt by (key, time range). A key of more than ``rows_per_task``
events is cut at quantiles of its event times; a range starts with the version
carried from the ranges before it. All other keys are one range. The cuts are
a DataFrame in the plan: at most events / rows_per_task times in all, so the
table is broadcast on that bound.

Versions of one key must not overlap (the suite tests that); where they do,
the one that starts last holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import fixed as FX
from starloom.operators.skew import ROWS_PER_TASK

FAR_FUTURE = FX.OPEN_VERSION_END
# Ranges over which events without a key or time are spread; they find no version.
KEYLESS_RANGES = 64


def time_cuts(events: DataFrame, key: str, ts: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(_cut_key, _cuts): ascending times that cut each key of more than ``rows_per_task`` events into ranges.

    Approximate quantiles: they move work between tasks, never results.
    """
    placed = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    counts = placed.groupBy(F.col(key).alias("_cut_key")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > rows_per_task).select("_cut_key", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_ranges"))
    times = placed.select(F.col(key).alias("_k"), F.col(ts).alias("_t")).join(F.broadcast(hot), F.col("_k") == F.col("_cut_key"))
    # One sketch a hot key, combined map-side; of its percentiles those at i / _ranges are cuts.
    marks = F.percentile_approx("_t", [i / 256 for i in range(1, 256)], 10_000)
    cuts = times.groupBy("_cut_key").agg(marks.alias("_p"), F.first("_ranges").alias("_ranges"))
    wanted = F.transform(F.sequence(F.lit(1), F.col("_ranges") - 1), lambda i: F.get("_p", F.least(F.ceil(i * 256 / F.col("_ranges")), F.lit(255)).cast("int") - 1))
    return cuts.select("_cut_key", F.array_sort(F.array_distinct(wanted)).alias("_cuts"))


def _range_of(cuts: Column, t: Column) -> Column:
    """The number of cuts at or before ``t``."""
    return F.coalesce(F.size(F.filter(cuts, lambda c: c <= t)), F.lit(0))


def _carried(versions: DataFrame, cuts: DataFrame) -> DataFrame:
    """For each cut of a hot key the version that stands last before it, as a version row of the range the cut opens."""
    opens = cuts.select(F.col("_cut_key").alias("_key"), F.explode("_cuts").alias("_at"))
    marks = opens.select("_key", "_at", F.lit(1).alias("_kind")).unionByName(
        versions.join(F.broadcast(cuts.select("_cut_key")), F.col("_key") == F.col("_cut_key"), "left_semi")
        .select("_key", "_at", F.lit(0).alias("_kind"), "_version"), allowMissingColumns=True)
    before = Window.partitionBy("_key").orderBy("_at", "_kind", F.col("_version.to").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (marks.withColumn("_version", F.last("_version", ignorenulls=True).over(before))
            .where((F.col("_kind") == 1) & F.col("_version").isNotNull()).select("_key", "_at", "_version"))


def asof_left_join(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    payload: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Attach ``payload`` of the version whose [valid_from, valid_to) holds ``ts``.

    Half-open interval; an open version (valid_to NULL) runs to 9999-12-31. Every event stays once;
    without a version, a key or a time its payload is NULL. The dimension is never broadcast (it grows with
    history). ``rows_per_task`` None: no key is cut.
    """
    end = F.coalesce(F.col(valid_to), F.to_timestamp(F.lit(FAR_FUTURE)))
    v = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_at"),
        F.struct(F.col(valid_from).alias("from"), end.alias("to"), *payload).alias("_version"))
    e = events.select(F.col(key).alias("_key"), F.col(ts).alias("_at"), F.struct(*events.columns).alias("_event"))
    keyless = F.col("_key").isNull() | F.col("_at").isNull()
    spread = F.pmod(F.xxhash64("_event"), F.lit(KEYLESS_RANGES)).cast("int")
    if rows_per_task is None:
        none = F.lit(0)
        rows = e.withColumn("_range", F.when(keyless, spread).otherwise(none)).unionByName(
            v.withColumn("_range", none), allowMissingColumns=True)
    else:
        cuts = time_cuts(events, key, ts, rows_per_task)

        def ranged(df: DataFrame) -> DataFrame:
            near = df.join(F.broadcast(cuts), F.col("_key") == F.col("_cut_key"), "left")
            return near.withColumn("_range", _range_of(F.col("_cuts"), F.col("_at"))).drop("_cut_key", "_cuts")

        placed = ranged(e).withColumn("_range", F.when(keyless, spread).otherwise(F.col("_range")))
        rows = placed.unionByName(ranged(v.unionByName(_carried(v, cuts))), allowMissingColumns=True)
    # At one time versions come first, a carried one before one that starts there, and the one that ends first before the others.
    order = [F.col("_at"), F.col("_event").isNotNull(), F.col("_version.from"), F.col("_version.to")]
    upto = Window.partitionBy("_key", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_last", F.last("_version", ignorenulls=True).over(upto)).where(F.col("_event").isNotNull())
    inside = F.col("_at") < F.col("_last.to")
    return found.select("_event.*", *[F.when(inside, F.col(f"_last.{c}")).alias(c) for c in payload])
