"""Base table x item tables -> wide label dataset."""

from __future__ import annotations

from collections.abc import Sequence
from posixpath import basename, dirname

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from assaykit.operators.wide import sized_label_wide
from assaykit.sinks.publish import parquet_writer, publish, refuse_existing, staging
from assaykit.sizing import BROADCAST_LIMIT
from assaykit.storage import Storage, literal_path

# The dictionary-encoded columns.
DICTIONARY_COLUMNS = ["usex", "split"]


def export_labels(
    base: DataFrame,
    items: Sequence[tuple[DataFrame, str]],
    output: str,
    expected_rows: int,
    overwrite: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> int:
    """Write the ordered wide dataset and return its rows.

    ``expected_rows`` must match unless it is 0. Nothing is published when it,
    or the row count of the written files, disagrees. Rows are counted behind
    the last shuffle, where a retried task is not counted twice.
    """
    if expected_rows < 0:
        raise ValueError("expected_rows must not be negative")
    spark = base.sparkSession
    storage = Storage(spark)
    target = storage.qualify(output)
    refuse_existing(spark, dirname(target), [basename(target)], overwrite)
    counter = Observation()
    wide = sized_label_wide(base, items, broadcast_limit)
    counted = wide.observe(counter, F.count("*").alias("rows"))
    with staging(spark, dirname(target)) as stage:
        data = f"{stage}/data"
        writer = parquet_writer(counted, "zstd").option("parquet.enable.dictionary", "false")
        for name in DICTIONARY_COLUMNS:
            writer = writer.option(f"parquet.enable.dictionary#{name}", "true")
        writer.save(data)
        rows = counter.get["rows"]
        if expected_rows and rows != expected_rows:
            raise RuntimeError(f"{rows} rows instead of the expected {expected_rows}")
        stored = spark.read.parquet(data).count()
        if stored != rows:
            raise RuntimeError(f"wrote {rows} rows but stored {stored}")
        publish(spark, stage, [(data, target)])
    return rows


def verify_export(spark: SparkSession, output: str) -> tuple[int, Row | None]:
    """Row count (from footers) and first record of a published dataset."""
    rows = spark.read.parquet(literal_path(output)).count()
    files = Storage(spark).children(output, "part-*")
    for entry in files if rows else []:
        first = spark.read.parquet(literal_path(entry.path)).limit(1).collect()
        if first:
            return rows, first[0]
    return rows, None
