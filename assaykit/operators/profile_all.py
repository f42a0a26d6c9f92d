"""The profiles of any number of item tables at once, from one aggregate over one scan.

Every value of a column that is to become a number is a cell. Cells are counted by table, column
and kind, with their value only where it cannot become a number; profile and most
frequent invalid values both follow from these counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assaykit.functions.numbers import is_numeric_text
from assaykit.functions.text import is_blank
from assaykit.operators.profile import (
    NORMAL_TARGETS,
    RESULT_TARGET,
    TOP_VALUES,
    TOP_VALUES_TWO_COLUMNS,
)
from assaykit.schema import KEYS

# Report -> its columns (with whether their targets take NULL) and how many rows it shows of a table.
REPORTS = {"result": (RESULT_TARGET, TOP_VALUES), "normals": (NORMAL_TARGETS, TOP_VALUES_TWO_COLUMNS)}
REPORT_OF = {name: report for report, (columns, _) in REPORTS.items() for name in columns}
TARGETS = {**RESULT_TARGET, **NORMAL_TARGETS}
MOST_SHOWN = max(limit for _, limit in REPORTS.values())


def _cell(name: str) -> Column:
    text = F.col(name).cast("string")
    numeric = F.coalesce(is_numeric_text(text), F.lit(False))
    bad = ~numeric & text.isNotNull() if TARGETS[name] else ~numeric
    return F.struct(
        F.lit(REPORT_OF[name]).alias("report"),
        F.lit(name).alias("column_name"),
        text.isNull().alias("missing"),
        F.coalesce(is_blank(text), F.lit(False)).alias("blank"),
        numeric.alias("numeric"),
        bad.alias("bad"),
        F.when(bad, text).alias("invalid_value"),
    )


def cells(df: DataFrame, *carry: str) -> DataFrame:
    """One row per row and column, with what is carried along."""
    return df.select(*carry, F.inline(F.array(*[_cell(name) for name in TARGETS])))


def count_cells(df: DataFrame, table: str) -> DataFrame:
    """Cells by table, column, kind and invalid value; counted before the shuffle."""
    kinds = ["report", "column_name", "missing", "blank", "numeric", "bad", "invalid_value"]
    return cells(df, table).groupBy(table, *kinds).agg(F.count("*").alias("rows_count"))


def profiles(counted: DataFrame, listed: DataFrame, table: str) -> DataFrame:
    """``table, column_name, total_rows, null_rows, blank_rows, numeric_rows, non_convertible_rows``.

    Every listed table has its lines; without rows the total is 0 and the other counts are NULL.
    """
    rows = F.col("rows_count")
    kinds = {"null_rows": "missing", "blank_rows": "blank", "numeric_rows": "numeric",
             "non_convertible_rows": "bad"}
    found = counted.groupBy(table, "column_name").agg(
        F.sum(rows).alias("total_rows"),
        *[F.sum(F.when(F.col(kind), rows).otherwise(0)).alias(name) for name, kind in kinds.items()],
    )
    lines = listed.select(table, F.explode(F.array(*map(F.lit, TARGETS))).alias("column_name"))
    total = F.coalesce("total_rows", F.lit(0)).alias("total_rows")
    return lines.join(found, [table, "column_name"], "left").select(
        table, "column_name", total, *kinds
    )


def _first_of_each(df: DataFrame, table: str, order: list[Column]) -> DataFrame:
    """The first rows of every table and report; each task sends no more than those it shows."""
    place = F.row_number().over(Window.partitionBy(table, "report").orderBy(*order)).alias("place")
    limits = F.create_map(*[F.lit(x) for report, (_, n) in REPORTS.items() for x in (report, n)])
    ranked = df.select("*", place).where(F.col("place") <= MOST_SHOWN)
    return ranked.where(F.col("place") <= limits[F.col("report")])


def invalid_values_of_all(counted: DataFrame, table: str) -> DataFrame:
    """``table, report, place, column_name, invalid_value, rows_count``: the most frequent ones."""
    order = [F.desc("rows_count"), F.asc("column_name"), F.asc_nulls_first("invalid_value")]
    columns = [table, "report", "column_name", "invalid_value", "rows_count"]
    found = _first_of_each(counted.where("bad").select(*columns), table, order)
    return found.select(table, "report", "place", *columns[2:])


def invalid_sample_of_all(df: DataFrame, table: str) -> DataFrame:
    """``table, report, place, column_name, uid, id, invalid_value``: the first by column and key."""
    order = [F.asc_nulls_first(name) for name in ["column_name", *KEYS, "invalid_value"]]
    bad = cells(df, table, *KEYS).where("bad")
    found = _first_of_each(bad.select(table, *KEYS, "report", "column_name", "invalid_value"), table, order)
    return found.select(table, "report", "place", "column_name", *KEYS, "invalid_value")
