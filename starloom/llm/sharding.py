"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned by (order columns, CRC-32 of the text). Each
partition sums its sizes; the running sum of those totals gives every partition
its offset, a window inside the partition gives every row its own, and the
total is cut at equal targets. A row goes to the shard that holds the middle
of its byte range, so a shard misses its target by less than one row.

Cases: a null text has size 1 and CRC 0. Null ids come first. Rows that repeat
an id are ordered by CRC; exact repeats are interchangeable, a running number
spreads them over the range partitions, and each gets a slot of its own; ties are decided so. A very
long text goes whole to one shard. An empty table gives no rows. Extra columns are ignored unless carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import written


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def byte_shards(docs: DataFrame, n_shards: int = 8, order_by: tuple[str, ...] = ("doc_id",),
                text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """order_by and carry columns, size, text_crc32, shard (0 to n_shards - 1) and slot (gapless from 0).

    Only these narrow rows are shuffled unless ``carry`` asks for the text.
    """
    names = [*order_by, *(c for c in carry if c not in order_by)]
    rows = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(names)],
                       text_size(F.col(text_col)).alias("size"), text_crc32(F.col(text_col)).alias("text_crc32"))
    order = [*(f"in_{i}" for i in range(len(order_by))), "text_crc32", "tie"]
    # The partition a row fell into is written with it: later reads agree on it whatever is recomputed.
    placed = written(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")

    # One row for each range partition, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                F.sum("bytes").over(Window.partitionBy()).alias("total")))
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.lit(2) * F.col("end") - F.col("size")  # twice the middle of the row's byte range
    ranked = (
        placed.withColumn("end", F.sum("size").over(upto)).withColumn("rank", F.row_number().over(inside).cast("long"))
        .join(F.broadcast(offsets), "part")
        .withColumn("end", F.col("end") + F.col("bytes_before"))
        .withColumn("position", F.col("rank") + F.col("rows_before") - 1)
        .withColumn("target", middle * n_shards)
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr("target div (2 * total)")).cast("int")))
    first = ranked.groupBy("shard").agg(F.min("position").alias("first_position"))  # n_shards rows
    return ranked.join(F.broadcast(first), "shard").select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(names)], "size", "text_crc32", "shard",
        (F.col("position") - F.col("first_position")).alias("slot"))
