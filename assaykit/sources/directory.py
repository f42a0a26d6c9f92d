"""Parquet directories: listing, schema agreement, scans that know their source."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from assaykit.functions.text import decode_path
from assaykit.journal import refuse_unfinished
from assaykit.sizing import BROADCAST_LIMIT, fits_broadcast, hint_broadcast, text_bytes
from assaykit.sources.local import local_frame
from assaykit.storage import Entry, Storage, literal_path

# Columns that carry a row's origin through a job; dropped before writing.
SOURCE = "__source"
FILE = "__file"
ROW = "__row"
FIRST = "__first"
NUMBER = "__number"


def list_sources(spark: SparkSession, directory: str, pattern: str) -> list[Entry]:
    """Files (or dataset directories) directly under a directory, by name; never none.

    Spark leaves out files whose names start with ``_`` or ``.``, so a match among
    those is an error here and not a gap in the result. So is a directory whose publication
    is not finished: it may hold results of two runs.
    """
    storage = Storage(spark)
    if not storage.is_dir(directory):
        raise NotADirectoryError(f"no such input directory: {directory}")
    refuse_unfinished(storage, directory)
    entries = storage.children(directory, pattern)
    if not entries:
        raise FileNotFoundError(f"nothing in {directory} matches {pattern!r}")
    hidden = [e.name for e in entries if not e.is_dir and e.name.startswith(("_", "."))]
    if hidden:
        raise ValueError(f"Spark does not read hidden files: {hidden[:10]}")
    return entries


def scan(spark: SparkSession, sources: Sequence[Entry]) -> DataFrame:
    """One DataFrame over all sources, with the schema of the first."""
    paths = [literal_path(entry.path) for entry in sources]
    reader = spark.read.option("mergeSchema", "false")
    return reader.schema(reader.parquet(paths[0]).schema).parquet(*paths)


def source_name(directory: str, file_path: Column) -> Column:
    """The name directly under a qualified directory that a path lies in, encoded as the path is."""
    if directory.startswith("file:"):
        file_path = F.replace(file_path, F.lit("file:///"), F.lit("file:/"))
    depth = directory.rstrip("/").count("/") + 2
    return F.substring_index(F.substring_index(file_path, "/", depth), "/", -1)


@dataclass(frozen=True)
class Origin:
    """Where rows come from, as one number that counts all rows in input order.

    Footers say how many rows each file has, so the number of a file's first row is a sum
    over the files before it and no data is read or sampled to order rows. The files' table
    (path, source, first number) is broadcast when its measured size allows.
    """

    sources: Sequence[Entry]
    files: DataFrame
    rows: int
    size: int
    small: bool
    encoded: bool

    @classmethod
    def of(
        cls, sources: Sequence[Entry], directory: str, footers: DataFrame,
        limit: int = BROADCAST_LIMIT,
    ) -> Origin:
        """``footers`` as ``read_footers`` gives them, stored; those of other sources are ignored."""
        spark = footers.sparkSession
        listed = local_frame(
            spark,
            {"filename": [e.name for e in sources], SOURCE: range(len(sources))},
            f"filename string, {SOURCE} int",
        )
        named = footers.withColumn("filename", source_name(directory, F.col("path")))
        # As rows spell their file, but for percent signs, which odd names alone need.
        path = F.replace("path", F.lit("file:///"), F.lit("file:/")).alias("path")
        known = named.join(listed, "filename").select(path, SOURCE, "rows", "bytes")
        before = Window.orderBy(SOURCE, "path").rowsBetween(Window.unboundedPreceding, -1)
        files = known.select(
            F.col("path").alias(FILE), SOURCE, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(FIRST))
        facts = known.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum(text_bytes("path")), F.lit(0)).alias("held"),
            F.count_if(F.col("path").rlike(r"[^\w.\-/:=]")).alias("odd"),
        ).first()
        small = fits_broadcast(facts["held"], limit)
        return cls(sources, files, facts["rows"], facts["bytes"], small, facts["odd"] > 0)

    def add(self, df: DataFrame) -> DataFrame:
        """The rows with their source and their number; a file that was not listed is an error."""
        path = F.replace(F.col("_metadata.file_path"), F.lit("file:///"), F.lit("file:/"))
        path = decode_path(path) if self.encoded else path
        located = df.select("*", path.alias(FILE), F.col("_metadata.row_index").alias(ROW))
        joined = located.join(hint_broadcast(self.files, self.small), FILE, "left")
        unknown = F.raise_error(F.concat(F.lit("not among the listed files: "), FILE)).cast("bigint")
        number = F.coalesce(F.col(FIRST), unknown) + F.col(ROW)
        return joined.withColumn(NUMBER, number).drop(FILE, ROW, FIRST)

    def name_of(self, directory_value: str) -> str:
        """The source behind a ``partitionBy`` directory's value."""
        return self.sources[int(directory_value)].name

    def with_names(self, counts: DataFrame) -> DataFrame:
        """``filename`` in place of the carried source."""
        names = local_frame(
            counts.sparkSession,
            {"filename": [e.name for e in self.sources], SOURCE: range(len(self.sources))},
            f"filename string, {SOURCE} int",
        )
        return counts.join(names, SOURCE).drop(SOURCE)


FOOTERS = "path string, bytes bigint, rows bigint, schema string"


def _footers(batches: Iterator) -> Iterator:
    """Read footers only, next to the data; one small row per file."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        paths = batch.column(0).to_pylist()
        rows, schemas = [], []
        for path in paths:
            if path.startswith("file:"):
                fs, inner = pafs.LocalFileSystem(), re.sub("^file:/*", "/", path)
            else:
                fs, inner = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
            with fs.open_input_file(inner) as handle:
                footer = pq.ParquetFile(handle)
                rows.append(footer.metadata.num_rows)
                schemas.append(
                    footer.schema_arrow.to_string(
                        show_field_metadata=False, show_schema_metadata=False
                    )
                )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(rows, pa.int64()),
                pa.array(schemas, pa.string()),
            ],
            names=["path", "bytes", "rows", "schema"],
        )


def read_footers(spark: SparkSession, sources: Sequence[Entry]) -> DataFrame:
    """Path, size, row count and schema text of every file, from footers alone.

    The listing comes from the ``binaryFile`` source with its content column
    pruned, so Spark packs many files into each task and no file body is read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "[!_.]*")
        .option("recursiveFileLookup", "true")
        .load([literal_path(entry.path) for entry in sources])
        .select("path", F.col("length").alias("bytes"))
    )
    tasks = spark.sparkContext.defaultParallelism * 4
    return listing.coalesce(tasks).mapInArrow(_footers, FOOTERS)


def require_same_schema(footers: DataFrame) -> None:
    """Every file must have exactly the first file's schema, names, types and order."""
    first_files = (
        footers.groupBy("schema")
        .agg(F.min("path").alias("path"))
        .orderBy("path")
        .limit(2)
        .collect()
    )
    if len(first_files) > 1:
        expected, other = first_files
        raise ValueError(
            f"{other.path} does not have the schema of the first source file\n"
            f"expected:\n{expected.schema}\nfound:\n{other.schema}"
        )
