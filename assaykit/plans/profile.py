"""Directories of item datasets -> their profiles, before any of them is converted."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from assaykit.functions.text import decode_path
from assaykit.operators.profile_all import (
    TARGETS,
    count_cells,
    invalid_sample_of_all,
    invalid_values_of_all,
    profiles,
)
from assaykit.schema import KEYS, require_columns
from assaykit.sinks.publish import (
    parquet_writer,
    publish,
    refuse_existing,
    refuse_overlap,
    staging,
)
from assaykit.sources.directory import (
    list_sources,
    read_footers,
    require_same_schema,
    scan,
    source_name,
)
from assaykit.sources.local import local_frame
from assaykit.storage import Storage

PROFILE = "profile.parquet"
INVALID_VALUES = "invalid_values.parquet"
INVALID_SAMPLE = "invalid_sample.parquet"
NAME = "filename"


def profile_datasets(
    spark: SparkSession,
    source_dir: str,
    output_dir: str,
    pattern: str = "*.parquet",
    overwrite: bool = False,
) -> None:
    """Profile, most frequent invalid values and a sample of invalid rows of every dataset.

    One scan counts and one finds the samples, both of the needed columns alone, however many
    datasets there are; the three reports are published together. All datasets must
    have one schema, as those of one split have. Datasets without rows have a profile too.
    """
    storage = Storage(spark)
    target_dir, directory = storage.qualify(output_dir), storage.qualify(source_dir)
    sources = list_sources(spark, source_dir, pattern)
    names = [PROFILE, INVALID_VALUES, INVALID_SAMPLE]
    targets = [f"{target_dir}/{name}" for name in names]
    refuse_overlap(targets, [entry.path for entry in sources])
    refuse_existing(spark, target_dir, names, overwrite)
    data = scan(spark, sources)
    require_columns(data.columns, [*KEYS, *TARGETS], source_dir)
    require_same_schema(read_footers(spark, sources))

    source = source_name(directory, F.col("_metadata.file_path"))
    rows = data.select(
        decode_path(source).alias(NAME), *[F.col(n).cast("string").alias(n) for n in [*KEYS, *TARGETS]]
    )
    listed = local_frame(spark, {NAME: [entry.name for entry in sources]}, f"{NAME} string")
    with staging(spark, target_dir) as stage:
        count_cells(rows, NAME).write.parquet(f"{stage}/counted")
        counted = spark.read.parquet(f"{stage}/counted")
        reports = [
            profiles(counted, listed, NAME),
            invalid_values_of_all(counted, NAME),
            invalid_sample_of_all(rows, NAME),
        ]
        for report, name in zip(reports, names):
            parquet_writer(report).save(f"{stage}/{name}")
        publish(spark, stage, [(f"{stage}/{n}", target) for n, target in zip(names, targets)])
