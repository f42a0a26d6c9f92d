"""Numeric text: recognising it, and converting it all or nothing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: optional blanks, sign, digits with an optional fraction, exponent.
NUMERIC_TEXT = r"^\s*[+-]?(([0-9]+([.][0-9]*)?)|([.][0-9]+))([eE][+-]?[0-9]+)?\s*$"

INFINITY = float("inf")


def is_numeric_text(col: Column) -> Column:
    return col.cast("string").rlike(NUMERIC_TEXT)


def not_convertible(col: Column, nullable: bool) -> Column:
    """Values a double column cannot take; NULL counts only if the target refuses NULL."""
    if nullable:
        return col.isNotNull() & ~is_numeric_text(col)
    return col.isNull() | ~is_numeric_text(col)


def is_finite(col: Column) -> Column:
    """Spark orders NaN above infinity, so one comparison refuses both."""
    return F.abs(col) < F.lit(INFINITY)


def finite_or_null(col: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(is_finite(col), col)


def to_double(col: Column, data_type: T.DataType, name: str, nullable: bool) -> Column:
    """Convert to a finite double, or fail the whole write on the first bad value.

    Text must look like a number *and* fit: ``1e400`` is numeric text but overflows.
    """
    if isinstance(data_type, T.NumericType):
        good = number = col.cast("double")
        accepted = is_finite(good)
    else:
        number = col.try_cast("double")
        accepted = is_numeric_text(col) & is_finite(number)
    complaint = F.raise_error(
        F.concat(F.lit(f"{name} cannot become a finite double: "), col.cast("string"))
    )
    if nullable:
        missing = F.lit(None).cast("double")
    else:
        missing = F.raise_error(F.lit(f"{name} must not be NULL")).cast("double")
    return (
        F.when(col.isNull(), missing)
        .when(accepted, number)
        .otherwise(complaint.cast("double"))
    )
