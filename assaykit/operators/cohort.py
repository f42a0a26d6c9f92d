"""Keeping, and accounting for, the exact key pairs of a cohort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from assaykit.operators.bloom import thinned
from assaykit.operators.coverage import TABLE, key_matrix, missing_pairs, numbered_keys, table_coverage
from assaykit.schema import KEYS
from assaykit.sizing import BROADCAST_LIMIT, fits_broadcast, hint_broadcast, text_bytes
from assaykit.sources.cohort import distinct_keys, key_columns, key_rows
from assaykit.sources.local import local_frame


def distinct_pairs(cohort: DataFrame) -> DataFrame:
    """The cohort's distinct keys, grouped as one struct so that a join shuffles them itself.

    AQE cuts a hot pair of the other side only where both sides of the join come
    straight from a shuffle, not where one side reuses an aggregation's.
    """
    pairs = key_rows(cohort).dropna().select(F.struct(*KEYS).alias("pair")).distinct()
    return pairs.select(*[F.col(f"pair.{name}").alias(name) for name in KEYS])


def keep_cohort(
    df: DataFrame, cohort: DataFrame, broadcast_keys: bool = False, bloom_keys: int | None = None
) -> DataFrame:
    """Rows whose whole (uid, id) pair is a cohort key; columns and bytes untouched.

    ``broadcast_keys`` is for a key set whose size was measured. Without it Spark
    decides, and in a shuffled join AQE splits a hot pair on the data side. ``bloom_keys``, the
    measured number of distinct keys, puts a Bloom filter of that size before such a
    join, so that few rows beyond the kept ones are shuffled.
    """
    temporary = [f"__key_{name}" for name in KEYS]
    keyed = df.withColumns(dict(zip(temporary, key_columns(df))))
    if bloom_keys and not broadcast_keys:
        keyed = thinned(keyed, [F.col(t) for t in temporary], key_rows(cohort).dropna(), bloom_keys)
    keys = distinct_pairs(cohort)
    wanted = keys.select(*[F.col(name).alias(t) for name, t in zip(KEYS, temporary)])
    kept = keyed.join(hint_broadcast(wanted, broadcast_keys), temporary, "left_semi")
    return kept.select(*df.columns)


def cohort_fits(cohort: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the cohort's distinct pairs, measured, are small enough to broadcast."""
    return fits_broadcast(key_stats(cohort).first()["key_bytes"], limit)


def missing_from(cohort: DataFrame, item: DataFrame, broadcast_keys: bool = False) -> DataFrame:
    """Cohort keys for which the item table has no row.

    ``broadcast_keys`` is for a cohort whose size was measured: it cuts the item
    table down where it is read. Both sides meet in one aggregation.
    """
    if broadcast_keys:
        item = key_rows(item).join(F.broadcast(distinct_keys(cohort)), KEYS, "left_semi")
    return missing_pairs(key_matrix(cohort, numbered_keys([item]), 1))


def tag_tables(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``table, uid, id`` over several item tables."""
    tagged = [
        key_rows(item, name).select(F.lit(name).alias("table"), *KEYS) for name, item in tables
    ]
    return reduce(DataFrame.unionAll, tagged)


def coverage(
    cohort: DataFrame, present: DataFrame, listed: DataFrame, broadcast_keys: bool = False
) -> DataFrame:
    """``table, count``: cohort keys that have a row in each listed item table.

    ``present`` holds ``table, uid, id`` of all item tables, ``listed`` the names, which the driver
    sees. One aggregation gives every pair a bit per table; a cohort measured to be small
    cuts the rows at the scan before it.
    """
    names = sorted({row["table"] for row in listed.select("table").collect()})
    numbers = local_frame(
        cohort.sparkSession, {"table": names, TABLE: range(len(names))}, f"table string, {TABLE} int")
    pairs = [col.alias(name) for name, col in zip(KEYS, key_columns(present))]
    keys = present.select("table", *pairs).dropna().join(F.broadcast(numbers), "table").select(*KEYS, TABLE)
    if broadcast_keys:
        keys = keys.join(F.broadcast(distinct_pairs(cohort)), KEYS, "left_semi")
    return table_coverage(key_matrix(cohort, keys, len(names)), names)


def key_stats(cohort: DataFrame) -> DataFrame:
    """``rows, keys, unusable, key_bytes``: how many rows repeat a key or lack a part.

    Rows are pre-counted per pair on the map side, so a hot pair costs one row
    per task.
    """
    per_pair = key_rows(cohort).groupBy(*KEYS).count()
    complete = F.col("uid").isNotNull() & F.col("id").isNotNull()
    return per_pair.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(complete).alias("keys"),
        F.coalesce(F.sum(F.when(complete, text_bytes(*KEYS))), F.lit(0)).alias("key_bytes"),
    ).select("rows", "keys", (F.col("rows") - F.col("keys")).alias("unusable"), "key_bytes")


def file_summary(df: DataFrame, cohort: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Source and retained rows per file, best first, including files with none.

    ``df`` carries the file in column ``name``; ``files`` lists every file, so
    that empty ones show 0. AQE splits a hot (or NULL) pair in the left join.
    """
    pairs = key_columns(df)
    probe = df.select(F.col(name).alias("filename"), *[c.alias(k) for k, c in zip(KEYS, pairs)])
    marked = probe.join(distinct_pairs(cohort).withColumn("hit", F.lit(1)), KEYS, "left")
    counts = marked.groupBy("filename").agg(
        F.count("*").alias("source_rows"), F.count("hit").alias("retained_rows")
    )
    return (
        files.join(counts, "filename", "left")
        .select(
            "filename",
            F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows"),
            F.coalesce("retained_rows", F.lit(0)).cast("bigint").alias("retained_rows"),
        )
        .orderBy(F.desc("retained_rows"), "filename")
    )
