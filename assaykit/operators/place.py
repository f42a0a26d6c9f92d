"""Placing rows into partitions that are in order, by numbers known beforehand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def whole(value: Column, by: int | Column) -> Column:
    """Integral division."""
    return F.call_function("div", value, F.lit(by) if isinstance(by, int) else by).cast("bigint")


def in_ranges(df: DataFrame, number: str, rows: int, partitions: int) -> DataFrame:
    """The rows in ``partitions`` ranges of a number below ``rows``, sorted in each.

    The range follows from the number alone: nothing is sampled.
    """
    step = max(1, -(-rows // partitions))
    part = whole(F.col(number), step).cast("int")
    return df.repartitionById(partitions, part).sortWithinPartitions(number)


def ranks(chunks: DataFrame, group: str) -> DataFrame:
    """``before`` beside ``group, chunk, rows``: rows of all smaller groups and, in the group,
    of all smaller chunks."""
    in_group = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunks.groupBy(group).agg(F.sum("rows").alias("total"))
    earlier = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("rows").over(in_group), F.lit(0)).alias("inside")
    return chunks.select(group, "chunk", "rows", inside).join(F.broadcast(starts), group).select(
        group, "chunk", "rows", (F.col("start") + F.col("inside")).alias("before"))


def in_groups(
    df: DataFrame, group: str, number: str, ranked: DataFrame, step: int, rows: int, partitions: int
) -> DataFrame:
    """The rows in ``partitions`` even ranges of (group, number), sorted in each.

    ``ranked`` tells how many rows come before each group's chunk of ``step`` numbers; within a
    chunk they are taken as evenly spread, which never changes their order.
    """
    names = {"chunk": "__chunk", "rows": "__rows", "before": "__before"}
    known = ranked.select(group, *[F.col(name).alias(own) for name, own in names.items()])
    located = df.withColumn("__chunk", whole(F.col(number), step)).join(known, [group, "__chunk"])
    offset = F.col(number) - F.col("__chunk") * step
    inside = whole(offset * F.col("__rows"), step)
    size = max(1, -(-rows // partitions))
    part = F.least(whole(F.col("__before") + inside, size), F.lit(partitions - 1)).cast("int")
    placed = located.withColumn("__part", part).drop(*names.values())
    placed = placed.repartitionById(partitions, F.col("__part")).drop("__part")
    return placed.sortWithinPartitions(group, number)
