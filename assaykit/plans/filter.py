"""Item datasets -> the same datasets, cohort pairs only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from assaykit.operators.cohort import keep_cohort, key_stats
from assaykit.operators.digest import observed_digest, require_same_content
from assaykit.operators.place import in_ranges
from assaykit.sinks.publish import (
    fill_empty,
    parquet_writer,
    publish,
    refuse_existing,
    refuse_overlap,
    require_codec,
    staging,
    write_csv,
)
from assaykit.sizing import BROADCAST_LIMIT, fits_broadcast, partitions_for
from assaykit.sources.cohort import key_columns, read_cohort
from assaykit.sources.directory import (
    NUMBER,
    SOURCE,
    Origin,
    list_sources,
    read_footers,
    scan,
    source_name,
)
from assaykit.sources.local import local_frame
from assaykit.storage import Entry, Storage

SUMMARY = "filter_summary.csv"
SUMMARY_SCHEMA = "filename string, source_rows bigint, retained_rows bigint"


def filter_by_cohort(
    spark: SparkSession,
    source_dir: str,
    cohort_path: str,
    output_dir: str,
    pattern: str = "*.parquet",
    compression: str = "zstd",
    overwrite: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    report: Callable[[Row], None] | None = None,
) -> DataFrame:
    """Write each source's cohort rows under its own name and the summary; return the summary.

    A key set measured to fit is broadcast and cuts the rows at the scan. A larger
    one is joined by shuffle, behind a Bloom filter of its keys at the scan. Either way the
    kept rows go into ranges of their row numbers, known from footers, so that a source's
    files are few and in order without sampling. What was written is read back and
    compared by its digest.

    Sources may differ in schema and each keeps its own. ``report`` is given the
    cohort's counts: rows, distinct pairs, and rows that repeat one or lack a part.
    """
    require_codec(compression)
    storage = Storage(spark)
    target_dir = storage.qualify(output_dir)
    if storage.qualify(source_dir).rstrip("/") == target_dir.rstrip("/"):
        raise ValueError("source and output directory must differ")
    sources = list_sources(spark, source_dir, pattern)
    targets = {entry.name: f"{target_dir}/{entry.name}" for entry in sources}
    summary_target = f"{target_dir}/{SUMMARY}"
    refuse_overlap(
        [*targets.values(), summary_target],
        [storage.qualify(cohort_path), *[entry.path for entry in sources]],
    )
    refuse_existing(spark, target_dir, [*targets, SUMMARY], overwrite)
    cohort = read_cohort(spark, cohort_path)
    stats = key_stats(cohort).first()
    if not stats["keys"]:
        raise ValueError(f"{cohort_path} holds no complete (uid, id) pair")
    if report:
        report(stats)
    small = fits_broadcast(stats["key_bytes"], broadcast_limit)

    directory = storage.qualify(source_dir)
    with staging(spark, target_dir) as stage:
        # Every footer is opened once: what they say is kept.
        name = source_name(directory, F.col("path")).alias("filename")
        read_footers(spark, sources).write.parquet(f"{stage}/footers")
        footers = spark.read.parquet(f"{stage}/footers")
        counts = footers.groupBy(name, "schema").agg(F.sum("rows").alias("rows"))
        groups = _schema_groups(counts, sources)
        staged, stored = {}, []
        for number, group in enumerate(groups):
            rows = scan(spark, group)
            key_columns(rows, source_dir)
            origin = Origin.of(group, directory, footers)
            data = f"{stage}/data-{number}"
            kept = retained_rows(rows, cohort, origin, small, stats["keys"])
            kept, seen = observed_digest(kept, kept.columns)
            parquet_writer(kept, compression).partitionBy(SOURCE).save(data)
            back = spark.read.schema(kept.schema).parquet(data)
            require_same_content(seen, back, kept.columns, target_dir)
            found = {
                origin.name_of(child.name.split("=", 1)[1]): child.path
                for child in storage.children(data, f"{SOURCE}=*")
            }
            empty = {
                entry.name: f"{stage}/empty-{number}-{index}"
                for index, entry in enumerate(group)
                if entry.name not in found
            }
            fill_empty(spark, rows, list(empty.values()), compression)
            staged.update(found)
            staged.update(empty)
            if found:
                written = spark.read.schema(f"{SOURCE} int").parquet(data)
                stored.append(origin.with_names(written.groupBy(SOURCE).count()))

        summary = _summary(spark, list(targets), counts, stored)
        write_csv(summary, f"{stage}/summary")
        moves = [(staged[name], target) for name, target in targets.items()]
        publish(spark, stage, [*moves, (f"{stage}/summary", summary_target)])
    return read_filter_summary(spark, summary_target)


def retained_rows(
    rows: DataFrame, cohort: DataFrame, origin: Origin, small: bool, keys: int | None = None
) -> DataFrame:
    """Cohort rows in input order, with their source."""
    kept = keep_cohort(origin.add(rows), cohort, broadcast_keys=small, bloom_keys=keys)
    partitions = partitions_for(rows.sparkSession, origin.size, origin.rows)
    return in_ranges(kept, NUMBER, origin.rows, partitions).drop(NUMBER)


def read_filter_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SUMMARY_SCHEMA, escape='"').orderBy(
        F.desc("retained_rows"), "filename"
    )


def _schema_groups(counts: DataFrame, sources: list[Entry]) -> list[list[Entry]]:
    """Sources with one schema are scanned together; usually that is all of them."""
    schemas = counts.select("schema").distinct()
    if len(schemas.limit(2).collect()) <= 1:
        return [sources]
    per_source = counts.groupBy(F.col("filename").alias("name")).agg(
        F.min("schema").alias("schema"), F.max("schema").alias("other")
    )
    groups: dict[str, list[Entry]] = {}
    by_name = {entry.name: entry for entry in sources}
    for row in per_source.orderBy("name").toLocalIterator():
        if row.schema != row.other:
            raise ValueError(f"the files of {row.name} differ in schema")
        groups.setdefault(row.schema, []).append(by_name[row.name])
    return list(groups.values())


def _summary(
    spark: SparkSession, names: list[str], counts: DataFrame, stored: list[DataFrame]
) -> DataFrame:
    """Source rows and rows written of every listed source, best first."""
    listed = local_frame(spark, {"filename": names}, "filename string")
    source = counts.groupBy("filename").agg(F.sum("rows").alias("rows"))
    none = local_frame(spark, {"filename": [], "count": []}, "filename string, count bigint")
    retained = reduce(DataFrame.unionByName, stored, none)
    return (
        listed.join(source, "filename", "left")
        .join(retained, "filename", "left")
        .select(
            "filename",
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("source_rows"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("retained_rows"),
        )
        .orderBy(F.desc("retained_rows"), "filename")
    )
