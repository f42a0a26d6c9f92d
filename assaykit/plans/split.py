"""Raw detail files -> one dataset per dictionary item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaykit.operators.digest import observed_digest, require_same_content
from assaykit.operators.items import counts_of, item_chunks, output_columns, prune_codes, select_items
from assaykit.operators.place import in_groups, ranks
from assaykit.schema import RAW_REQUIRED, require_columns
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
from assaykit.sources.dictionary import read_items
from assaykit.sizing import ROW_OVERHEAD, fits_broadcast, hint_broadcast, partitions_for
from assaykit.sources.directory import (
    NUMBER,
    SOURCE,
    Origin,
    list_sources,
    read_footers,
    require_same_schema,
    scan,
)
from assaykit.sources.local import local_frame
from assaykit.storage import Storage

SUMMARY = "export_summary.csv"
SUMMARY_SCHEMA = "itemname string, itemcode string, rows bigint, filename string"
ITEM = "__item"
# Most pairs of an item and a chunk of rows that are counted apart, and chunks a partition.
MOST_CHUNKS = 1_000_000
CHUNKS_PER_PARTITION = 4


def split_by_item(
    spark: SparkSession,
    input_dir: str,
    items_csv: str,
    output_dir: str,
    pattern: str = "*.parq",
    compression: str = "zstd",
    overwrite: bool = False,
    max_rows_per_file: int | None = None,
) -> DataFrame:
    """Write one dataset per item and the summary; return the summary.

    The code column is read once to count (and strictly decode) every code, per chunk
    of the input; then the needed columns are read with the codes pushed to the scan.
    Footers number all rows, and the counts say which partition a numbered row of an item
    falls in: an item's files, and the rows in them, are in input order, and a hot item is
    cut into several files of the session's advisory size, without sampling. What was
    written is read back and compared by its digest.
    """
    require_codec(compression)
    storage = Storage(spark)
    items = read_items(spark, items_csv)
    sources = list_sources(spark, input_dir, pattern)
    raw = scan(spark, sources)
    require_columns(raw.columns, RAW_REQUIRED, input_dir)

    # The dictionary is job configuration: its rows become the output names.
    filenames = [row.filename for row in items.orderBy("line").collect()]
    colons = [name for name in filenames if ":" in name]
    if colons:
        raise ValueError(f"Hadoop file names cannot hold a colon: {colons[:10]}")
    target_dir = storage.qualify(output_dir)
    targets = [f"{target_dir}/{name}" for name in filenames]
    summary_target = f"{target_dir}/{SUMMARY}"
    refuse_overlap([*targets, summary_target], [entry.path for entry in sources])
    refuse_existing(spark, target_dir, [*filenames, SUMMARY], overwrite)

    footers = read_footers(spark, sources).persist()
    try:
        require_same_schema(footers)
        origin = Origin.of(sources, storage.qualify(input_dir), footers)
        numbered = origin.add(raw)
        wished = partitions_for(spark, origin.size, origin.rows)
        chunks = min(CHUNKS_PER_PARTITION * wished, max(1, MOST_CHUNKS // len(filenames)))
        step = max(1, -(-origin.rows // chunks))
        with staging(spark, target_dir) as stage:
            item_chunks(numbered, items, NUMBER, step).write.parquet(f"{stage}/chunks")
            spread = spark.read.parquet(f"{stage}/chunks")
            counted = counts_of(spread, items).collect()
            found = [row for row in counted if row.rows]
            data = f"{stage}/data"
            if found:
                rows = sum(row.rows for row in found)
                partitions = partitions_for(spark, origin.size * rows // origin.rows, rows)
                ranked = ranks(spread.withColumnRenamed("line", ITEM), ITEM)
                small = fits_broadcast(ROW_OVERHEAD * len(found) * chunks)
                selected = selected_rows(raw, origin, [(r.itemcode, r.line) for r in found])
                placed = in_groups(
                    selected, ITEM, NUMBER, hint_broadcast(ranked, small), step, rows, partitions
                ).drop(SOURCE, NUMBER)
                placed, seen = observed_digest(placed, placed.columns)
                writer = parquet_writer(placed, compression)
                if max_rows_per_file:
                    writer = writer.option("maxRecordsPerFile", max_rows_per_file)
                writer.partitionBy(ITEM).save(data)
                _require_counts(spark, data, {row.line: row for row in found})
                back = spark.read.schema(placed.schema).parquet(data)
                require_same_content(seen, back, placed.columns, target_dir)

            staged = {row.line: f"{data}/{ITEM}={row.line}" for row in found}
            empty = {row.line: f"{stage}/empty-{row.line}" for row in counted if not row.rows}
            fill_empty(spark, raw.select(*output_columns(raw)), list(empty.values()), compression)
            staged.update(empty)

            names = ["itemname", "itemcode", "rows", "filename"]
            report = {name: [row[name] for row in counted] for name in names}
            summary = local_frame(spark, report, SUMMARY_SCHEMA)
            write_csv(summary.coalesce(1), f"{stage}/summary")
            moves = [(staged[row.line], target) for row, target in zip(counted, targets)]
            publish(spark, stage, [*moves, (f"{stage}/summary", summary_target)])
    finally:
        footers.unpersist()
    return summary


def selected_rows(raw: DataFrame, origin: Origin, codes: list[tuple[str, int]]) -> DataFrame:
    """Decoded rows of the given codes with their item number, source and row number.

    Every code was decoded strictly when it was counted, so the scan may compare
    stored bytes and skip row groups.
    """
    listed = {"itemcode": [code for code, _ in codes], ITEM: [number for _, number in codes]}
    numbered = local_frame(raw.sparkSession, listed, f"itemcode string, {ITEM} bigint")
    wanted = prune_codes(raw, listed["itemcode"])
    return select_items(origin.add(wanted), numbered, carry=[ITEM])


def _require_counts(spark: SparkSession, data: str, expected: dict) -> None:
    """Rows stored per item must be the rows counted in the source (footers only)."""
    counts = spark.read.schema(f"{ITEM} bigint").parquet(data).groupBy(ITEM).count()
    stored = {row[ITEM]: row["count"] for row in counts.collect()}
    for line, row in expected.items():
        if stored.get(line, 0) != row.rows:
            raise RuntimeError(
                f"item {row.itemcode}: {row.rows} rows in the source, {stored.get(line, 0)} stored"
            )
