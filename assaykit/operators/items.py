"""Splitting long-form rows by item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from assaykit.functions.text import as_text
from assaykit.schema import RAW_REQUIRED, RESULT_COLUMNS, require_columns


def code_text(df: DataFrame) -> Column:
    """itemcode as text; only text or bytes can hold a code."""
    require_columns(df.columns, ["itemcode"], "source")
    found = df.schema["itemcode"].dataType
    if not isinstance(found, (T.StringType, T.BinaryType)):
        raise TypeError(f"itemcode must be text or bytes, not {found.simpleString()}")
    return as_text(F.col("itemcode"), found)


def output_columns(df: DataFrame) -> list[Column]:
    """Per-item columns: no ``rn``, results as text, bytes decoded, the rest as it is."""
    require_columns(df.columns, RAW_REQUIRED, "source")
    columns = []
    for field in df.schema:
        if field.name == "rn":
            continue
        col = F.col(field.name)
        if field.name in RESULT_COLUMNS or isinstance(field.dataType, T.BinaryType):
            col = as_text(col, field.dataType)
        columns.append(col.alias(field.name))
    return columns


def select_items(df: DataFrame, items: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows whose exact code is listed, decoded, with ``carry`` columns of the dictionary.

    Codes are unique in the dictionary, so the join adds no rows. Its size is
    the dictionary's: Spark broadcasts it below the session's threshold and
    otherwise shuffles, where AQE splits a hot code.
    """
    keyed = df.withColumn("__code", code_text(df))
    wanted = items.select(F.col("itemcode").alias("__code"), *carry)
    how = "inner" if carry else "left_semi"
    joined = keyed.join(wanted, "__code", how)
    return joined.select(*output_columns(df), *carry)


def prune_codes(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """A filter on the stored form of itemcode, which reaches the Parquet scan.

    It compares undecoded bytes, so use it only once every code has been decoded
    strictly (the split job counts them first), never as the only check.
    """
    if isinstance(df.schema["itemcode"].dataType, T.BinaryType):
        listed = [F.lit(bytearray(code.encode("utf-8"))) for code in codes]
    else:
        listed = list(codes)
    return df.where(F.col("itemcode").isin(listed))


def item_counts(df: DataFrame, items: DataFrame) -> DataFrame:
    """Rows per dictionary item, 0 for the unmatched, in dictionary order.

    Reads one column. Codes are counted before the shuffle, so a hot code costs
    one row per task.
    """
    counts = df.select(code_text(df).alias("itemcode")).groupBy("itemcode").count()
    return (
        items.join(counts, "itemcode", "left")
        .select(
            "line",
            "itemname",
            "itemcode",
            F.coalesce("count", F.lit(0)).cast("bigint").alias("rows"),
            "filename",
        )
        .orderBy("line")
    )


def item_chunks(df: DataFrame, items: DataFrame, number: str, step: int) -> DataFrame:
    """``line, chunk, rows``: listed items' rows among each ``step`` consecutive row numbers.

    Reads the code column, and decodes every code strictly, listed or not. Counted before the
    shuffle: a task sends one row per code and chunk that it reads.
    """
    chunk = F.floor(F.col(number) / F.lit(step)).cast("bigint").alias("chunk")
    counts = df.select(code_text(df).alias("itemcode"), chunk).groupBy("itemcode", "chunk").count()
    wanted = items.select("itemcode", "line")
    return counts.join(wanted, "itemcode").select("line", "chunk", F.col("count").alias("rows"))


def counts_of(chunks: DataFrame, items: DataFrame) -> DataFrame:
    """``item_counts`` from the counts of chunks."""
    rows = chunks.groupBy("line").agg(F.sum("rows").alias("found"))
    return items.join(rows, "line", "left").select(
        "line", "itemname", "itemcode", F.coalesce("found", F.lit(0)).cast("bigint").alias("rows"), "filename"
    ).orderBy("line")


def total_rows(summary: DataFrame) -> DataFrame:
    """All rows over all items or files."""
    return summary.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))
