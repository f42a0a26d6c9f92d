"""Inputs, intermediate tables and sizes that the operators share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(column: str, folds: int):
    """crc32 of the id as text, modulo `folds`; null stays null."""
    return F.crc32(F.col(column).cast("string")) % folds


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Only a local session, in which driver and executors are one process, may leave the
    setting out.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The frame written once as Parquet to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Above this, an estimate of Spark's is taken for a guess and the texts are measured.
PLAUSIBLE_BYTES = 1 << 47


def input_bytes(df: DataFrame, text: str) -> int:
    """Spark's estimate of the frame's size; for a Parquet scan, that of its files.

    Frames whose size Spark cannot tell have absurd estimates; their texts are measured.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > PLAUSIBLE_BYTES:
        size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return size


def shards(df: DataFrame, text: str, per_shard: int) -> int:
    """How many shards of about `per_shard` input bytes the frame makes; the session's
    shuffle partitions at least."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(df, text) // per_shard))


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest whole bytes each; the first byte is their width."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    """What `pack` was given, as int64; values of 2^63 and more do not occur."""
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as eight planes, the high bytes together, which compress well."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)


def small_enough(ids: DataFrame, most: int) -> bool:
    """Whether the frame holds at most `most` rows, counted without reading on beyond that."""
    return ids.limit(most + 1).count() <= most
