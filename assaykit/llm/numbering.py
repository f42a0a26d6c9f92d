"""Row numbers of a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import stored


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their place 0, 1, 2, ... in the given order, as a long column.

    Rows are ranged by the order, so that a hot key is cut into several ranges, numbered within each
    range, and moved on by the sizes of the ranges before. Equal rows are numbered in any order.
    The driver sees nothing; the sizes, one a range, are broadcast.
    """
    # The id holds the partition above bit 33 and the place in it below.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id()))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(F.shiftright("__at", 33).alias("__range")).agg(F.count("*").alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    moved = placed.withColumn("__range", F.shiftright("__at", 33)).join(F.broadcast(starts), "__range")
    return moved.withColumn(name, F.col("__start") + place).drop("__range", "__at", "__start")
