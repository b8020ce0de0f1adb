"""Data-quality tests as DataFrames.

Every test yields exactly one row ``(test_name, model, column_name, test_type,
severity, failures)``; ``status`` is derived from failures and severity. The
test semantics follow the common warehouse conventions:

* ``unique``: one failure per duplicated non-NULL value
* ``not_null``: one failure per NULL row (all columns of a model in one pass)
* ``accepted_values``: one failure per distinct offending value; NULL passes
* ``relationships``: one failure per orphan child row; NULL passes
* singular tests: one failure per returned row

The whole suite is one plan. The keys of a column are counted once for all tests
on it, together with those that relationships compare them with, by one
aggregation, combined map-side so that a hot value costs one partial row per
task; only that column is read. NULLs and values are told by one pass a model.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import packed_text

RESULT_COLS = ["test_name", "model", "column_name", "test_type", "severity", "failures"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # unique | not_null | accepted_values | relationships
    values: tuple[str, ...] = ()
    to_model: str = ""
    to_column: str = ""
    severity: str = "error"
    source: bool = False
    name_override: str = field(default="")

    @property
    def name(self) -> str:
        if self.name_override:
            return self.name_override
        prefix = "source_" if self.source else ""
        base = f"{prefix}{self.test}_{self.model}_{self.column}"
        if self.test == "accepted_values":
            base += "__" + "__".join(self.values)
        if self.test == "relationships":
            base += f"__{self.to_column}__ref_{self.to_model}_"
        return base


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _marks(checks: list[Check]) -> dict[str, list[Column]]:
    """For each model what its rows say to the checks of single rows: (test, key), NULL where they say nothing."""
    marks: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.test == "not_null":
            when, key = col.isNull(), F.lit("")
        elif c.test == "accepted_values":
            when, key = ~col.isin(list(c.values)), col.cast("string")  # NULL -> NULL -> says nothing (passes)
        else:
            continue
        marks.setdefault(c.model, []).append(F.when(when, F.struct(F.lit(i).alias("test"), key.alias("key"))))
    return marks


def _domains(checks: list[Check]) -> list[list[tuple[str, str]]]:
    """The (model, column) sites whose keys are counted, those that relationships compare in one list."""
    of: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for c in checks:
        if c.test not in ("unique", "relationships"):
            continue
        joined = of.setdefault((c.model, c.column), [(c.model, c.column)])
        if c.test == "relationships":
            parent = of.setdefault((c.to_model, c.to_column), [(c.to_model, c.to_column)])
            if parent is not joined:
                joined.extend(parent)
                of.update(dict.fromkeys(parent, joined))
    return list({id(sites): sites for sites in of.values()}.values())


def _keys(models: dict[str, DataFrame], sites: list[tuple[str, str]]) -> list[list[Column]]:
    """The key columns of each site, small enough to shuffle: whole numbers as long, hex digests as bytes, else texts."""
    types = [[models[m].schema[c].dataType for c in column.split(",")] for m, column in sites]
    whole = all(isinstance(t, INTEGRAL) for of in types for t in of)
    if len(types[0]) > 1 and not whole:
        return [[packed_text(F.to_json(F.struct(*column.split(",")), {"ignoreNullFields": "false"})).alias("k0")] for _, column in sites]
    return [[(F.col(c).cast("long") if whole else packed_text(F.col(c).cast("string"))).alias(f"k{j}") for j, c in enumerate(column.split(","))]
            for _, column in sites]


def _key_failures(models: dict[str, DataFrame], checks: list[Check], sites: list[tuple[str, str]]) -> DataFrame:
    """(test, n) of the unique and relationships checks on the keys of ``sites``: how often each key stands at each site, counted
    in one aggregation combined map-side."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    keys = None
    for place, ((model, column), key) in enumerate(zip(sites, _keys(models, sites), strict=True)):
        part = models[model].select(*key, *[(one if k == place else none).alias(f"n{k}") for k in range(len(sites))])
        if "," not in column:
            part = part.where(F.col("k0").isNotNull())
        keys = part if keys is None else keys.unionByName(part)
    counted = keys.groupBy(*[c for c in keys.columns if c.startswith("k")]).agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(sites))])
    at = {site: F.col(f"n{k}") for k, site in enumerate(sites)}
    failed = []
    for i, c in enumerate(checks):
        if (c.model, c.column) not in at:
            continue
        here = at[c.model, c.column]
        if c.test == "unique":
            failed.append(F.struct(F.lit(i).alias("test"), (here > 1).cast("long").alias("n")))
        elif c.test == "relationships":
            failed.append(F.struct(F.lit(i).alias("test"), F.when(at[c.to_model, c.to_column] == 0, here).otherwise(none).alias("n")))
    return counted.select(F.explode(F.filter(F.array(*failed), lambda x: x["n"] > 0)).alias("f")).select("f.*")


def suite_failures(models: dict[str, DataFrame], checks: list[Check], rows: dict[int, DataFrame] | None = None) -> DataFrame:
    """(test, failures) of the checks that fail, by their place in ``checks``.

    Rows with a NULL or a value that is not allowed emit a mark each, one pass a model. Keys that must be unique
    or refer to each other are counted once a column, whatever the number of checks on it, and only that column
    is read. ``rows``: further tests, by number, whose offending rows count.
    """
    unknown = {c.test for c in checks} - {"unique", "not_null", "accepted_values", "relationships", "singular"}
    if unknown:
        raise ValueError(f"unknown test {min(unknown)}")
    marks = [models[m].select(F.explode(F.array(*said)).alias("m")).where(F.col("m").isNotNull()).select("m.*")
             for m, said in _marks(checks).items()]
    parts = [_key_failures(models, checks, sites) for sites in _domains(checks)]
    if marks:
        # A row a NULL, but a row a distinct value.
        values = [i for i, c in enumerate(checks) if c.test == "accepted_values"]
        said = reduce(DataFrame.unionByName, marks).groupBy("test", "key").agg(F.count(F.lit(1)).alias("n"))
        parts.append(said.select("test", F.when(F.col("test").isin(values), F.lit(1).cast("long")).otherwise(F.col("n")).alias("n")))
    parts += [offending.select(F.lit(i).alias("test"), F.lit(1).cast("long").alias("n")) for i, offending in (rows or {}).items()]
    return reduce(DataFrame.unionByName, parts).groupBy("test").agg(F.sum("n").alias("failures"))


def _listed(checks: list[Check], offenders: dict[str, tuple[str, DataFrame]] | None) -> tuple[list[Check], dict[int, DataFrame]]:
    """The checks followed by the singular tests, and the latter's offending rows by number."""
    named = [Check(model=model, column="", test="singular", name_override=name) for name, (model, _) in (offenders or {}).items()]
    return [*checks, *named], {len(checks) + k: o for k, (_, o) in enumerate((offenders or {}).values())}


def run_checks(models: dict[str, DataFrame], checks: list[Check],
               offenders: dict[str, tuple[str, DataFrame]] | None = None) -> DataFrame:
    """All declared checks, and the singular tests ``offenders``, as one lazy DataFrame (one row per check)."""
    every, rows = _listed(checks, offenders)
    spark = next(iter(models.values())).sparkSession
    names = spark.createDataFrame([(i, c.name, c.model, c.column, c.test, c.severity) for i, c in enumerate(every)],
                                  "test int, test_name string, model string, column_name string, test_type string, severity string")
    found = suite_failures(models, checks, rows)
    # A row a test on both sides: bounded by the suite, so the failures are broadcast.
    return names.join(F.broadcast(found), "test", "left").select(
        *RESULT_COLS[:-1], F.coalesce("failures", F.lit(0).cast("long")).alias("failures"))


def with_status(results: DataFrame) -> DataFrame:
    failed = F.col("failures") > 0
    status: Column = F.when(~failed, F.lit("pass")).when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail"))
    return results.withColumn("status", status)


# Evaluation now ------------------------------------------------------------------
RESULT_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _status(failures: int, severity: str) -> str:
    if failures == 0:
        return "pass"
    return "warn" if severity == "warn" else "fail"


def evaluate(models: dict[str, DataFrame], checks: list[Check],
             offenders: dict[str, tuple[str, DataFrame]] | None = None) -> list[tuple]:
    """Run the suite as one job; a row per check in their order (bounded by the suite, not the data)."""
    every, rows = _listed(checks, offenders)
    found = {r["test"]: r["failures"] for r in suite_failures(models, checks, rows).collect()}
    return [(c.name, c.model, c.column, c.test, c.severity, found.get(i, 0), _status(found.get(i, 0), c.severity))
            for i, c in enumerate(every)]


def results_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RESULT_SCHEMA)
