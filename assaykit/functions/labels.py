"""Coded values: the range label and the sex code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def range_label(result: Column, low: Column, high: Column) -> Column:
    """0 inside the inclusive range, 1 outside it, NULL when any part is unknown."""
    unknown = result.isNull() | low.isNull() | high.isNull()
    return (
        F.when(unknown, F.lit(None))
        .when(result.between(low, high), F.lit(0))
        .otherwise(F.lit(1))
        .cast("tinyint")
    )


# Spellings of each sex code.
SEX_CODES = {"MAN": ["男", "MAN"], "WOMAN": ["女", "WOMAN"]}
SEX_UNKNOWN = "UNK"


def sex_code(col: Column) -> Column:
    spelled = F.trim(col.cast("string"))
    code = F.lit(SEX_UNKNOWN)
    for value, spellings in SEX_CODES.items():
        code = F.when(spelled.isin(spellings), F.lit(value)).otherwise(code)
    return code
