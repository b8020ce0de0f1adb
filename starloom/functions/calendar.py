"""Calendar parts, names and the day spine. Session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts: str | Column) -> Column:
    """yyyymmdd as a long, computed arithmetically (no string round trip)."""
    d = F.to_date(_col(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def date_name(d: str | Column, part: str) -> Column:
    """Full English month ('month') or weekday ('weekday') name."""
    pattern = {"month": "MMMM", "weekday": "EEEE"}[part]
    return F.date_format(_col(d), pattern)


def iso_day_of_week(d: str | Column) -> Column:
    """ISO day of week: 1 = Monday .. 7 = Sunday."""
    return (F.weekday(_col(d)) + 1).cast("long")


def date_part(part: str, d: str | Column) -> Column:
    """year | quarter | month | day | isodow | isoweek, as long."""
    d = _col(d)
    fn = {
        "year": F.year,
        "quarter": F.quarter,
        "month": F.month,
        "day": F.dayofmonth,
        "isoweek": F.weekofyear,
        "isodow": lambda x: F.weekday(x) + 1,
    }[part]
    return fn(d).cast("long")


def is_weekend(d: str | Column) -> Column:
    return iso_day_of_week(d) >= 6


def day_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from start to end inclusive, column ``date_day``.

    A single generated row exploded into the sequence: the size is bounded by
    the date range (about 365 rows a year), not by the data.
    """
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias("date_day")
    )


def day_spine_covering(spark: SparkSession, start: str, end: str, covers: list[DataFrame]) -> DataFrame:
    """Days from ``start`` to ``end``, widened to cover every date in ``covers``.

    ``covers`` are single-column DataFrames of dates or timestamps. Their
    min/max are aggregated (map-side; Parquet statistics help) and the spine
    is generated from that one row, so the output is bounded by the date
    range and no value passes through the driver.
    """
    if not covers:
        return day_spine(spark, start, end)
    ranges = None
    for c in covers:
        col = F.to_date(F.col(c.columns[0]))
        r = c.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
        ranges = r if ranges is None else ranges.unionByName(r)
    bounds = ranges.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = F.least(F.to_date(F.lit(start)), F.col("lo"))
    last = F.greatest(F.to_date(F.lit(end)), F.col("hi"))
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day"))
