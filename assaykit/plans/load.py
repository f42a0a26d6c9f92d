"""One Parquet dataset -> one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from assaykit.sinks.tables import load_table
from assaykit.storage import Storage, literal_path


def load_parquet(
    spark: SparkSession,
    path: str,
    table: str,
    if_exists: str = "fail",
    not_null: Sequence[str] = (),
) -> int:
    """Load a dataset into a catalog table and return the rows written."""
    if not Storage(spark).exists(path):
        raise FileNotFoundError(f"no such dataset: {path}")
    return load_table(spark.read.parquet(literal_path(path)), table, if_exists, not_null)
