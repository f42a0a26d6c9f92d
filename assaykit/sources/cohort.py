"""Cohort keys: the exact (uid, id) pairs to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from assaykit.functions.text import as_text
from assaykit.schema import KEYS, require_columns
from assaykit.storage import literal_path


def key_columns(df: DataFrame, what: str = "data") -> list:
    """uid and id as text, bytes decoded strictly; other types are refused."""
    require_columns(df.columns, KEYS, what)
    for name in KEYS:
        found = df.schema[name].dataType
        if not isinstance(found, (T.StringType, T.BinaryType)):
            raise TypeError(f"{what}: {name} must be text or bytes, not {found.simpleString()}")
    return [as_text(F.col(name), df.schema[name].dataType) for name in KEYS]


def key_rows(df: DataFrame, what: str = "data") -> DataFrame:
    """The two key columns as text, one row per input row."""
    return df.select(*[col.alias(name) for name, col in zip(KEYS, key_columns(df, what))])


def distinct_keys(df: DataFrame) -> DataFrame:
    """Each complete pair once; a pair with a NULL part is no key."""
    return key_rows(df).dropna().distinct()


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """The key columns of a cohort file; nothing else of it is read."""
    return key_rows(spark.read.parquet(literal_path(path)), path)
