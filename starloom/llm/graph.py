"""Joins and connected components that keep a hot key off a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import unused, written

#: A key is hot if it holds more than 1/SHARE of the rows; so at most SHARE keys are, and their list can be broadcast.
SHARE = 200
#: Parts that the rows of a hot key are dealt to.
PARTS = 256
#: Rows of a join that one task can take, whatever their keys.
SMALL = 1 << 18


def spread_join(big: DataFrame, small: DataFrame, key: str, rows: str, total: int | None = None) -> DataFrame:
    """The inner join of ``big`` with ``small`` on ``key``, hot keys dealt to PARTS parts each.

    ``small`` has one row a key; its column ``rows`` counts the rows of ``big`` with that key, ``total`` is their
    sum. Up to SMALL rows in all one task can take any key, and the join is a plain one. Beyond that ``small``
    is read three times and should be a written table. Null keys find nothing.
    """
    total = (small.agg(F.sum(rows)).first()[0] or 0) if total is None else total
    if total <= SMALL:
        return big.join(small, key)
    hot = small.filter(F.col(rows) * SHARE > total).select(key)
    if hot.isEmpty():
        return big.join(small, key)
    part, flag = unused(big.columns + small.columns, "part", "hot")
    marked = big.join(F.broadcast(hot.withColumn(flag, F.lit(True))), key, "left")
    spread = F.when(F.col(flag), F.pmod(F.xxhash64(*big.columns), F.lit(PARTS))).otherwise(F.lit(0).cast("long"))
    every = F.when(F.col(rows) * SHARE > total, F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).otherwise(
        F.array(F.lit(0).cast("long")))
    return marked.withColumn(part, spread).drop(flag).join(small.withColumn(part, F.explode(every)), [key, part]).drop(part)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the least node of its component.

    Large-star and small-star rounds, each written, until every component is one star: no node is linked to two
    others, or both to a lesser and by a greater one. A hub's edges are pre-aggregated for its least neighbour
    and, beyond SMALL edges, spread for the join.
    """
    current = written(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct(), "edges")
    while True:
        n = current.count()
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(current.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        if 2 * n > SMALL:
            least = written(least, "least")
        large = spread_join(both, least, "u", "n", 2 * n).filter("v > u and m < v").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = written(large.distinct(), "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
        n = large.count()
        if n > SMALL:
            low = written(low, "low")
        small = spread_join(large, low, "hi", "n", n).select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        current = written(small.select("e.hi", "e.lo").filter("lo < hi").distinct(), "small-star")
        ends = current.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            current.select("lo", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").isEmpty():
            break
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())
