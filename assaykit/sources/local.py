"""Small frames made of job settings, such as listings and the dictionary."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, columns: dict[str, Iterable], schema: str) -> DataFrame:
    """A frame held by the plan itself, read by no Python worker."""
    fields = T.StructType.fromDDL(schema)
    table = pa.table(
        {name: list(values) for name, values in columns.items()}, schema=to_arrow_schema(fields)
    )
    return spark.createDataFrame(table, fields)
