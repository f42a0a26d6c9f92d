"""Measured sizes decide what may be broadcast; nothing is broadcast on trust."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Estimated bytes in memory up to which a measured key set is broadcast.
BROADCAST_LIMIT = 128 * 1024 * 1024
# Hash-table cost per row beyond the text itself.
ROW_OVERHEAD = 64


def text_bytes(*columns: str):
    """Bytes of the given text columns plus the per-row cost."""
    total = F.lit(ROW_OVERHEAD).cast("bigint")
    for name in columns:
        total = total + F.coalesce(F.octet_length(name), F.lit(0))
    return total


def fits_broadcast(size: int, limit: int = BROADCAST_LIMIT) -> bool:
    return size <= limit


def hint_broadcast(df: DataFrame, fits: bool) -> DataFrame:
    """Broadcast a frame whose size was checked, else leave the join to AQE."""
    return F.broadcast(df) if fits else df


# Rows below which a task of its own does not pay.
TASK_ROWS = 50_000
# Rows that one task sorts or groups at most, however few bytes they take in files or shuffles.
MOST_ROWS = 1_000_000


def advisory_bytes(spark: SparkSession) -> int:
    """The session's size of a partition, which is that of an output file too."""
    value = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def partitions_for(spark: SparkSession, size: int, rows: int) -> int:
    """Partitions for so many bytes and rows: of the advisory size and of ``MOST_ROWS`` at most,
    or one a core for less."""
    by_size = -(-size // advisory_bytes(spark))
    by_cores = min(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return max(1, by_size, by_cores, -(-rows // MOST_ROWS))
