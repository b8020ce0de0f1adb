"""Incremental loads: high-water filter and delete+insert on a unique key, as
DataFrames. ``publish`` writes such a load to a table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import fixed as FX
from starloom.functions import packed_text, unpacked_text
from starloom.session import TABLE_COMPRESSION, scratch_path

EPOCH_DEFAULT = FX.EMPTY_HIGH_WATER
# A reader that answers aggregates from Parquet footers.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro", "spark.sql.parquet.aggregatePushdown": "true",
               "spark.sql.session.timeZone": "UTC"}


class SchemaDrift(ValueError):
    """The incoming rows do not have the target table's schema."""


def high_water_mark(target: DataFrame | None, column: str, default: str = EPOCH_DEFAULT) -> dt.datetime:
    """``coalesce(max(column), default)`` of the target, as one driver scalar.

    A single aggregated value; Parquet min/max statistics let the scan skip
    most of the data.
    """
    if target is None:
        return dt.datetime.fromisoformat(default)
    v = target.agg(F.max(column).alias("m")).first()["m"]
    return v if v is not None else dt.datetime.fromisoformat(default)


def greatest_in_files(spark: SparkSession, paths: list[str], schema: T.StructType, column: str) -> DataFrame:
    """(m): the greatest ``column`` (a timestamp) of Parquet files, from the statistics in their footers.

    The V2 reader answers ``max`` from footers, but not for timestamps, whose older encoding has no order.
    Files written with TIMESTAMP_MICROS hold 64-bit integers; read as such, in the files' own column order, the
    plan shows the pushed maximum and no column data is read. ``schema`` is that of the files.
    """
    session = spark.newSession()  # these settings hold for this one read
    for k, v in FOOTER_CONF.items():
        session.conf.set(k, v)
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name == column else f.dataType) for f in schema.fields])
    return session.read.schema(stored).parquet(*paths).agg(F.max(column).alias("m")).select(F.timestamp_micros("m").alias("m"))


def high_water_of_files(spark: SparkSession, paths: list[str], schema: T.StructType, column: str, default: str = EPOCH_DEFAULT) -> dt.datetime:
    """``high_water_mark`` from file statistics; the column is scanned where the files have none (older timestamp encoding)."""
    if not paths:
        return dt.datetime.fromisoformat(default)
    try:
        found = greatest_in_files(spark, paths, schema, column).first()["m"]
    except Exception:  # no usable statistics
        found = spark.read.schema(schema).parquet(*paths).agg(F.max(column).alias("m")).first()["m"]
    return found if found is not None else dt.datetime.fromisoformat(default)


def newer_than(df: DataFrame, column: str, mark: dt.datetime) -> DataFrame:
    """Strictly newer rows (ties with the mark are skipped, as in the warehouse)."""
    return df.where(F.col(column) > F.lit(mark))


def newer_than_target(df: DataFrame, column: str, target: DataFrame, default: str = EPOCH_DEFAULT) -> DataFrame:
    """``where column > (select coalesce(max(column), default) from target)``.

    Kept as an uncorrelated scalar subquery in the plan: no driver round trip,
    and the Parquet scan receives it as a pushed filter at run time.
    """
    mark = target.select(F.coalesce(F.max(column), F.to_timestamp(F.lit(default))).alias("m")).scalar()
    return df.where(F.col(column) > mark)


def check_schema(incoming: T.StructType, target: T.StructType) -> None:
    """``on_schema_change='fail'``: names and types must be equal, in order."""
    a = [(f.name, f.dataType.simpleString()) for f in incoming.fields]
    b = [(f.name, f.dataType.simpleString()) for f in target.fields]
    if a != b:
        raise SchemaDrift(f"schema change on incremental load: {a} != {b}")


def redelivered(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Those rows of ``target`` (its key and what else it selects) whose key comes again in ``new``.

    Only these columns move, a digest as bytes. The rows are written, so that the planner knows how few they
    are and the table itself stays where it is.
    """
    text = isinstance(target.schema[key].dataType, T.StringType)
    small = packed_text(key) if text else F.col(key)
    again = target.withColumn(key, small).join(new.select(small.alias(key)), key, "left_semi")
    path = scratch_path(target.sparkSession, "redelivered")
    found = again.withColumn(key, unpacked_text(key)) if text else again
    found.select(*target.columns).write.parquet(path, compression=TABLE_COMPRESSION)
    return target.sparkSession.read.schema(target.schema).parquet(path)


def delete_insert(target: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is re-delivered are replaced by the new rows."""
    if target is None:
        return new
    check_schema(new.schema, target.schema)
    again = redelivered(target.select(key), new, key)
    return target.join(again, key, "left_anti").unionByName(new)
