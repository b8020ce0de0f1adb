"""Tables published by version: readers see a whole load or none of it.

A load writes the partitions it changes to a directory of its own and then one
small pointer file that names the directories of every partition::

    <table>/data/load=<id>/<partition column>=<value>/part-*.parquet
    <table>/versions/00000003.json

A reader takes the pointer of the highest number. The pointer is written under
a temporary name and renamed last, so until then readers resolve the version
before, and afterwards the new one; nothing that a pointer names is ever
changed. Two loads that start from one version cannot both publish: the
rename of the second finds the number taken.

The pointer has a line a partition and load, the only thing that goes through
the driver; rows go from executors to files. A failed load leaves files that
no pointer names; ``expire`` removes them together with old versions.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import packed_text, unpacked_text
from starloom.operators.incremental import SchemaDrift, check_schema, high_water_of_files, redelivered
from starloom.session import TABLE_COMPRESSION, prepare, scratch_path
from starloom.sources import fs

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another load has published since this one read the table."""


@dataclass(frozen=True)
class Version:
    """One published state: its number, the columns, and the load directories of each partition value."""

    number: int
    schema: T.StructType
    partition_col: str
    parts: dict[str, tuple[str, ...]]


def _versions(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n[:-5]) for n in fs.children(spark, f"{table}/versions") if n.endswith(".json") and n[:-5].isdigit())


def resolve(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """The version of that number, or the latest; None where nothing was published."""
    numbers = _versions(spark, table)
    if number is None and not numbers:
        return None
    number = numbers[-1] if number is None else number
    if number not in numbers:
        raise ValueError(f"{table} has no version {number}")
    said = json.loads(fs.read_text(spark, f"{table}/versions/{number:08d}.json"))
    return Version(number, T.StructType.fromJson(said["schema"]), said["partition_col"],
                   {k: tuple(v) for k, v in said["parts"].items()})


def read(spark: SparkSession, table: str, version: Version | int | None = None, only: list[str] | None = None) -> DataFrame:
    """The rows of a version (default: the latest); ``only``: of these partition values."""
    v = version if isinstance(version, Version) else resolve(spark, table, version)
    if v is None:
        raise ValueError(f"nothing was published in {table}")
    paths = _paths(table, v, only)
    if not paths:
        return spark.createDataFrame([], v.schema)
    full = T.StructType([*v.schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(full).option("basePath", f"{table}/data").parquet(*paths).select(*v.schema.fieldNames())


def _paths(table: str, v: Version, only: list[str] | None = None) -> list[str]:
    values = v.parts if only is None else [p for p in only if p in v.parts]
    return [f"{table}/data/load={load}/{v.partition_col}={value}" for value in values for load in v.parts[value]]


def high_water(spark: SparkSession, table: str, column: str) -> dt.datetime:
    """The greatest value of a timestamp column of the latest version, from file statistics."""
    v = resolve(spark, table)
    if v is None:
        raise ValueError(f"nothing was published in {table}")
    stored = T.StructType([f for f in v.schema.fields if f.name != v.partition_col])
    return high_water_of_files(spark, _paths(table, v), stored, column)


def _write_load(spark: SparkSession, rows: DataFrame, table: str, partition_col: str, digests: list[str] | None = None) -> tuple[str, list[str]]:
    """Write rows to a load directory of their own; its id and the partition values it holds. Columns ``digests`` move as bytes."""
    load = uuid.uuid4().hex
    path = f"{table}/data/load={load}"
    prepare(spark)
    small = {c: packed_text(c) for c in digests or [] if c in rows.columns}
    dealt = rows.withColumns(small).hint("rebalance", partition_col).withColumns({c: unpacked_text(c) for c in small})
    dealt.write.partitionBy(partition_col).parquet(path, compression=TABLE_COMPRESSION)
    prefix = f"{partition_col}="
    return load, [n[len(prefix):] for n in fs.children(spark, path) if n.startswith(prefix)]


def _point(spark: SparkSession, table: str, version: Version) -> None:
    """Publish: the one step that readers see."""
    text = json.dumps({"schema": version.schema.jsonValue(), "partition_col": version.partition_col, "parts": version.parts})
    temporary = f"{table}/versions/_{uuid.uuid4().hex}"
    fs.write_text(spark, temporary, text)
    if not fs.rename_new(spark, temporary, f"{table}/versions/{version.number:08d}.json"):
        fs.delete(spark, temporary)
        raise Conflict(f"{table} has a version {version.number} of another load")


def create(spark: SparkSession, rows: DataFrame, table: str, partition_col: str, digests: list[str] | None = None) -> Version:
    """Publish ``rows`` as the whole table: version 1, or the next one, of which no partition is kept.

    ``digests``: text columns that mostly hold hex digests, for a smaller shuffle; the table is the same without them.
    """
    old = resolve(spark, table)
    if dict(rows.dtypes)[partition_col] != "string":
        raise SchemaDrift(f"partition column {partition_col} must be a string")
    load, values = _write_load(spark, rows, table, partition_col, digests)
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in rows.schema.fields])
    version = Version(old.number + 1 if old else 1, schema, partition_col, {v: (load,) for v in values})
    _point(spark, table, version)
    return version


def replace(spark: SparkSession, table: str, base: Version, drop: list[str], rows: DataFrame | None, append: DataFrame | None = None,
            digests: list[str] | None = None) -> Version:
    """Publish the version after ``base``: partitions ``drop`` go, those of ``rows`` stand for them, ``append`` adds to what is there."""
    parts = {k: v for k, v in base.parts.items() if k not in drop}
    for df in (rows, append):
        if df is None:
            continue
        check_schema(df.schema, base.schema)
        load, values = _write_load(spark, df, table, base.partition_col, digests)
        for value in values:
            parts[value] = (*parts.get(value, ()), load)
    version = Version(base.number + 1, base.schema, base.partition_col, parts)
    _point(spark, table, version)
    return version


def delete_insert(spark: SparkSession, new: DataFrame, table: str, key: str, digests: list[str] | None = None) -> dict:
    """Load ``new`` into the table: rows of a re-delivered key are replaced, the others added.

    Touched partitions are those of the new rows and those that hold a re-delivered key (found by a semi join
    that reads key and partition column). Only they are read and rewritten; without new rows there is no new
    version. Returns counts for the build log.
    """
    base = resolve(spark, table)
    if base is None:
        raise ValueError(f"nothing was published in {table}")
    col = base.partition_col
    check_schema(new.schema, base.schema)
    staged = scratch_path(spark, "publish", "new")
    new.write.parquet(staged, compression=TABLE_COMPRESSION)  # computed once; its size is then known to the planner
    new = spark.read.schema(base.schema).parquet(staged)
    again = redelivered(read(spark, table, base).select(key, col), new, key)
    named = F.coalesce(F.col(col), F.lit(NULL_PARTITION)).alias(col)
    touched = [r[0] for r in new.select(col).union(again.select(col)).select(named).distinct().collect()]  # at most the partitions
    if not touched:
        return {"mode": "noop", "touched_partitions": 0, "version": base.number}
    kept = read(spark, table, base, only=touched).join(again.select(key), key, "left_anti").select(*base.schema.fieldNames())
    version = replace(spark, table, base, touched, kept.unionByName(new), digests=digests)
    return {"mode": "delete+insert", "touched_partitions": len(touched), "version": version.number}


def expire(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions and every load that none of them names; the number of loads removed.

    Not beside a running load, whose directory no pointer names yet.
    """
    numbers = _versions(spark, table)
    named = {load for n in numbers[-keep:] for loads in resolve(spark, table, n).parts.values() for load in loads}
    for n in numbers[:-keep]:
        fs.delete(spark, f"{table}/versions/{n:08d}.json")
    unnamed = [d for d in fs.children(spark, f"{table}/data") if d.startswith("load=") and d[len("load="):] not in named]
    for d in unnamed:
        fs.delete(spark, f"{table}/data/{d}")
    return len(unnamed)
