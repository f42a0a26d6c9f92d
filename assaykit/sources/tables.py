"""Base and item tables, from the catalog or through JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows fetched or inserted per round trip.
BATCH_ROWS = 5_000


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    batch_rows: int = BATCH_ROWS,
    split_on: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """A database table in bounded batches.

    ``split_on`` is (column, lower, upper, partitions) and reads the table in
    that many ranges at once; without it one task reads the whole table.
    """
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    options = {**properties, "fetchsize": str(batch_rows)}
    if split_on is None:
        return spark.read.jdbc(url, table, properties=options)
    column, lower, upper, partitions = split_on
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )
