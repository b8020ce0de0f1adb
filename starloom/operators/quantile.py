"""Exact order statistics of a whole table without ordering it in one task.

The values between the least and the greatest are cut into BINS ranges of
equal width and counted; the range that holds the wanted rank is cut again,
until it is one value. A pass is one aggregation that combines map-side and
returns at most BINS rows a rank to the driver, whatever the table's size; a
64-bit value takes at most log(2^64) / log(BINS) = 7 passes. Skew does no harm:
a value that a third of the rows share is one counted row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path

#: Ranges that a pass counts for each wanted rank.
BINS = 1024


def counted_values(values: DataFrame, value: str) -> DataFrame:
    """(v, n): the distinct values (64-bit integers, NULL left out) and their numbers, written once for the passes."""
    path = scratch_path(values.sparkSession, "quantile")
    values.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    return values.sparkSession.read.parquet(path)


def values_at_ranks(counted: DataFrame, ranks: list[int], lo: int, hi: int) -> dict[int, int]:
    """The values at 1-based ranks of a ``counted_values`` table whose values lie in [lo, hi]."""
    found = {r: (lo, hi, 0) for r in ranks}  # range that holds the rank, rows below it
    while True:
        open_ranges = sorted({(a, b) for a, b, _ in found.values() if a < b})
        if not open_ranges:
            return {r: a for r, (a, _, _) in found.items()}
        widths = {(a, b): (b - a) // BINS + 1 for a, b in open_ranges}
        # Decimals: the distance of two 64-bit integers can need 65 bits.
        parts = [counted.where(F.col("v").between(a, b)).select(
            F.lit(i).alias("i"), F.expr(f"cast((cast(v as decimal(20,0)) - {a}BD) div {widths[a, b]}BD as bigint)").alias("bin"), "n")
            for i, (a, b) in enumerate(open_ranges)]
        rows = parts[0]
        for other in parts[1:]:
            rows = rows.union(other)
        bins: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in rows.groupBy("i", "bin").agg(F.sum("n").alias("n")).collect():  # at most BINS a range
            bins.setdefault(open_ranges[r["i"]], []).append((r["bin"], r["n"]))
        for rank, (a, b, below) in found.items():
            if a == b:
                continue
            for number, n in sorted(bins[a, b]):
                if below + n >= rank:
                    start = a + number * widths[a, b]
                    found[rank] = (start, min(b, start + widths[a, b] - 1), below)
                    break
                below += n


def spread_of(values: DataFrame, value: str, prefix: str) -> DataFrame:
    """One row: rows, least, exact median (mean of the middle two) and greatest of an integer column; NULLs do not count.

    Runs its passes when called; the result is the row.
    """
    spark = values.sparkSession
    counted = counted_values(values, value)
    total = counted.agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    schema = f"rows long, {prefix}_min_ms long, {prefix}_median_ms double, {prefix}_max_ms long"
    if not total["n"]:
        return spark.createDataFrame([(None, None, None, None)], schema)
    n, lo, hi = total["n"], total["lo"], total["hi"]
    lower, upper = (n + 1) // 2, n // 2 + 1
    at = values_at_ranks(counted, sorted({lower, upper}), lo, hi)
    return spark.createDataFrame([(n, lo, (at[lower] + at[upper]) / 2.0, hi)], schema)
