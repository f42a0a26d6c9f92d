"""Profiling text columns before they become numbers.

The NOT NULL variants serve ``itemresult``, the nullable ones the two bounds of
the normal range. Each function reads its table once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assaykit.functions.numbers import is_numeric_text, not_convertible
from assaykit.functions.text import is_blank
from assaykit.schema import KEYS

# How many invalid values and sample rows a report shows.
TOP_VALUES = 100
TOP_VALUES_TWO_COLUMNS = 200
# The two nullable columns, in report order.
NORMAL_COLUMNS = ["normallowvalue", "normalhighvalue"]
# Which double columns take NULL.
RESULT_TARGET = {"itemresult": False}
NORMAL_TARGETS = dict.fromkeys(NORMAL_COLUMNS, True)


def _count_where(condition: Column) -> Column:
    """SUM over a predicate: NULL, not 0, over no rows at all."""
    return F.sum(condition.cast("bigint"))


def profile_columns(df: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """``column_name, total_rows, null_rows, blank_rows, numeric_rows, non_convertible_rows``.

    ``columns`` says of each column whether its target takes NULL. One pass for all
    columns, one pattern match per value: the non-convertible rows are what the
    other counts leave over.
    """
    counts = [F.count("*").alias("total_rows")]
    for name in columns:
        col = F.col(name)
        counts += [
            _count_where(col.isNull()).alias(f"null_{name}"),
            _count_where(F.coalesce(is_blank(col), F.lit(False))).alias(f"blank_{name}"),
            _count_where(F.coalesce(is_numeric_text(col), F.lit(False))).alias(f"numeric_{name}"),
        ]
    lines = []
    for name, nullable in columns.items():
        nulls, numeric = F.col(f"null_{name}"), F.col(f"numeric_{name}")
        convertible = nulls + numeric if nullable else numeric
        lines.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("total_rows"),
                nulls.alias("null_rows"),
                F.col(f"blank_{name}").alias("blank_rows"),
                numeric.alias("numeric_rows"),
                (F.col("total_rows") - convertible).alias("non_convertible_rows"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def profile_result(df: DataFrame) -> DataFrame:
    """The one-line profile of ``itemresult`` for a NOT NULL double."""
    return profile_columns(df, RESULT_TARGET).drop("column_name")


def profile_normals(df: DataFrame) -> DataFrame:
    """One profile line per bound, for nullable doubles."""
    return profile_columns(df, NORMAL_TARGETS)


def invalid_results(df: DataFrame) -> DataFrame:
    """Rows whose ``itemresult`` cannot become a NOT NULL double."""
    return df.where(not_convertible(F.col("itemresult"), nullable=False))


def invalid_normals(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``column_name, [carry], invalid_value``: one row per bound that cannot become a double.

    Rows with two good bounds are dropped before the columns are stacked.
    """
    bad = {name: not_convertible(F.col(name), nullable=True) for name in NORMAL_COLUMNS}
    flagged = df.select(
        *carry,
        *[F.when(bad[name], F.col(name).cast("string")).alias(name) for name in NORMAL_COLUMNS],
    )
    stacked = flagged.where(F.coalesce(*NORMAL_COLUMNS).isNotNull()).select(
        *carry,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column_name"), F.col(n).alias("invalid_value"))
                    for n in NORMAL_COLUMNS
                ]
            )
        ),
    )
    return stacked.where("invalid_value is not null").select(
        "column_name", *carry, "invalid_value"
    )


def invalid_result_values(df: DataFrame, limit: int = TOP_VALUES) -> DataFrame:
    """The most frequent invalid results; NULL is a group of its own."""
    return (
        invalid_results(df)
        .groupBy("itemresult")
        .agg(F.count("*").alias("rows_count"))
        .orderBy(F.desc("rows_count"), F.asc_nulls_first("itemresult"))
        .limit(limit)
    )


def invalid_normal_values(df: DataFrame, limit: int = TOP_VALUES_TWO_COLUMNS) -> DataFrame:
    """The most frequent invalid bounds over both columns."""
    return (
        invalid_normals(df)
        .groupBy("column_name", "invalid_value")
        .agg(F.count("*").alias("rows_count"))
        .orderBy(F.desc("rows_count"), "column_name", "invalid_value")
        .limit(limit)
    )


def invalid_result_sample(
    df: DataFrame, limit: int = TOP_VALUES, stable: bool = False
) -> DataFrame:
    """Some offending rows; ``stable`` costs a full read for the same rows every time."""
    rows = invalid_results(df).select(*KEYS, "itemresult")
    return (rows.orderBy(*KEYS, "itemresult") if stable else rows).limit(limit)


def invalid_normal_sample(
    df: DataFrame, limit: int = TOP_VALUES_TWO_COLUMNS, stable: bool = False
) -> DataFrame:
    """Some offending rows over both columns, tagged with the column."""
    rows = invalid_normals(df, KEYS)
    order = ["column_name", *KEYS, "invalid_value"]
    return (rows.orderBy(*order) if stable else rows).limit(limit)


def require_convertible(profile: DataFrame) -> None:
    """Gate before a conversion: no row may be left over."""
    bad = profile.where("non_convertible_rows > 0").collect()
    if bad:
        raise ValueError(
            "not convertible to double: " + ", ".join(str(row.asDict()) for row in bad)
        )
