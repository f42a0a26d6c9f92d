"""Text tables -> typed item tables, step by step or at once.

A conversion to double is itself the gate: what cannot become one raises inside the write, and the
table stays as it is. The profile is only read to say what was in the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from assaykit.operators.convert import (
    convert_keys,
    convert_normals,
    convert_result,
    convert_unit,
    to_item_table,
)
from assaykit.operators.profile import (
    NORMAL_TARGETS,
    RESULT_TARGET,
    profile_columns,
    require_convertible,
)
from assaykit.sinks.tables import convert_table


def _explained(
    spark: SparkSession, table: str, columns: dict[str, bool], convert: Callable[[], int]
) -> int:
    """Run a conversion; if it fails, values that are no numbers are counted and named."""
    try:
        return convert()
    except PySparkException:
        require_convertible(profile_columns(spark.table(table), columns))
        raise


def convert_item_keys(spark: SparkSession, table: str, buckets: int | None = None) -> int:
    """uid through itemname; the original stays as a backup table."""
    return convert_table(spark, table, convert_keys, buckets=buckets, unique_keys=True)


def convert_result_column(spark: SparkSession, table: str) -> int:
    """itemresult, if every value can become a double."""
    return _explained(
        spark, table, RESULT_TARGET,
        lambda: convert_table(spark, table, convert_result, keep_backup=False),
    )


def convert_normal_columns(spark: SparkSession, table: str) -> int:
    """Both normal bounds together, if every value can become a double or is NULL."""
    return _explained(
        spark, table, NORMAL_TARGETS,
        lambda: convert_table(spark, table, convert_normals, keep_backup=False),
    )


def convert_unit_column(spark: SparkSession, table: str) -> int:
    return convert_table(spark, table, convert_unit, keep_backup=False)


def convert_item_table(spark: SparkSession, table: str, buckets: int | None = None) -> int:
    """All conversions in one rewrite, behind the same gates, with a backup.

    With ``buckets`` the table is read once; without, the keys are read back once.
    """
    return _explained(
        spark, table, {**RESULT_TARGET, **NORMAL_TARGETS},
        lambda: convert_table(spark, table, to_item_table, buckets=buckets, unique_keys=True),
    )
