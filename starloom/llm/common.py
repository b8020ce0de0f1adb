"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.session import scratch_path

#: ASCII white space; words are what stands between.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
#: Words of a shingle, in every near-duplicate operator here.
SHINGLE_WORDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table below the shared checkpoint folder, read again.

    Cuts the lineage, outlives lost executors, and gives the planner a known
    size for what reads it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null and for blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT, -1), "")


def text_key(text: Column) -> Column:
    """128-bit identity of a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names with underscores in front until no column has them (letter case ignored)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, rejected: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) is not in ``rejected`` (doc_id, tk = text_key).

    Null ids compare equal; columns and repeated rows of ``docs`` stay as they are.
    """
    tk, rid, rtk = unused(docs.columns, "_tk", "_rid", "_rtk")
    gone = rejected.select(F.col("doc_id").alias(rid), F.col("tk").alias(rtk)).distinct()
    keyed = docs.withColumn(tk, text_key(F.col(text_col)))
    return keyed.join(gone, keyed[id_col].eqNullSafe(gone[rid]) & (keyed[tk] == gone[rtk]), "left_anti").drop(tk)
