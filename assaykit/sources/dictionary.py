"""The item dictionary: which codes to extract and what to call them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaykit.functions.text import item_filename, strip_whitespace
from assaykit.schema import require_columns
from assaykit.storage import Storage, literal_path


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """``line, itemname, itemcode, filename`` in file order, checked.

    The dictionary is one small file kept in one partition, which is what makes
    the running row number follow the file.
    """
    if not Storage(spark).is_file(path):
        raise FileNotFoundError(f"no such item dictionary: {path}")
    literal = literal_path(path)
    if not spark.read.text(literal).where(~F.is_valid_utf8("value")).isEmpty():
        raise ValueError(f"{path} is not valid UTF-8")

    table = spark.read.csv(literal, header=True, multiLine=True, escape='"', encoding="UTF-8")
    table = table.toDF(*[name.removeprefix("﻿") for name in table.columns])
    require_columns(table.columns, ["itemname", "itemcode"], path)
    items = (
        table.coalesce(1)
        .select(
            (F.monotonically_increasing_id() + 2).alias("line"),
            strip_whitespace(F.coalesce("itemname", F.lit(""))).alias("itemname"),
            strip_whitespace(F.coalesce("itemcode", F.lit(""))).alias("itemcode"),
        )
        .withColumn("filename", item_filename(F.col("itemname"), F.col("itemcode")))
    )
    require_valid_items(items, path)
    return items


def item_problems(items: DataFrame) -> DataFrame:
    """Dictionary rows that break a rule, each with the first rule it breaks.

    A repeated code or file name is one that an earlier line already has, found
    from the first line of each instead of by ordering whole groups.
    """
    first_code = items.groupBy("itemcode").agg(F.min("line").alias("first_code"))
    first_file = items.groupBy("filename").agg(F.min("line").alias("first_file"))
    empty = (F.col("itemname") == "") | (F.col("itemcode") == "")
    return (
        items.join(first_code, "itemcode")
        .join(first_file, "filename")
        .select(
            "line",
            F.when(empty, "itemname and itemcode must not be empty")
            .when(
                F.col("line") > F.col("first_code"),
                F.concat(F.lit("itemcode listed twice: "), "itemcode"),
            )
            .when(
                F.col("line") > F.col("first_file"),
                F.concat(F.lit("same file name twice: "), "filename"),
            )
            .alias("problem"),
        )
        .where("problem is not null")
    )


def require_valid_items(items: DataFrame, path: str) -> None:
    first = item_problems(items).orderBy("line").limit(1).collect()
    if first:
        raise ValueError(f"{path}, line {first[0].line}: {first[0].problem}")
    if items.isEmpty():
        raise ValueError(f"{path} lists no items")
