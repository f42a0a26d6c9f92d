"""Catalog and database tables: loading, and conversion through a shadow table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from assaykit.operators.convert import non_finite_to_null, observed_keys, require_unique_keys
from assaykit.schema import KEYS, require_flat, require_unique_names
from assaykit.sources.tables import BATCH_ROWS, read_jdbc
from assaykit.storage import Storage

MODES = ("fail", "append", "replace")


def require_table_name(table: str) -> None:
    if not all(re.fullmatch(r"[0-9A-Za-z_]+", part) for part in table.split(".")):
        raise ValueError(f"table name {table!r} may hold only letters, digits and underscores")


def require_same_columns(existing: Sequence[str], offered: Sequence[str], table: str) -> None:
    """Appending needs the same names in the same order, not just the same set."""
    if list(existing) != list(offered):
        raise ValueError(
            f"columns of {table} are {list(existing)}, the data has {list(offered)}"
        )


def loadable(df: DataFrame, not_null: Sequence[str] = ()) -> DataFrame:
    """The frame as a table takes it: scalar columns, no NaN, untyped NULLs as text."""
    require_unique_names(df.columns)
    require_flat(df.schema)
    untyped = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    clean = non_finite_to_null(df).withColumns({n: F.col(n).cast("string") for n in untyped})
    checks = {
        name: F.coalesce(
            F.col(name),
            F.raise_error(F.lit(f"{name} must not be NULL")).cast(clean.schema[name].dataType),
        )
        for name in not_null
    }
    return clean.withColumns(checks)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows as the last step before the write, where a retry is not counted twice."""
    counter = Observation()
    return df.observe(counter, F.count("*").alias("rows")), counter


def _own_name(table: str, purpose: str) -> str:
    """A name that only this attempt uses; what a failed one leaves behind is in nobody's way."""
    return f"{table}__{purpose}_{uuid.uuid4().hex}"


def _discard(spark: SparkSession, table: str) -> None:
    """Drop an own table, and the folder that a failed write leaves without one."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    folder = spark.catalog.getDatabase(database).locationUri
    Storage(spark).delete(f"{folder.rstrip('/')}/{name.lower()}")


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str], list[str]] | None:
    """Number of buckets, bucket columns and sort columns of a table, or None."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if not facts.get("Num Buckets"):
        return None
    columns, order = (
        re.findall(r"`([^`]+)`", facts.get(name) or "") for name in ("Bucket Columns", "Sort Columns")
    )
    return int(facts["Num Buckets"]), columns, order


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _swap(spark: SparkSession, table: str, shadow: str, backup: str) -> None:
    """Two renames, not atomic in Spark: if the second fails, the first is undone."""
    _rename(spark, table, backup)
    try:
        _rename(spark, shadow, table)
    except Exception:
        _rename(spark, backup, table)
        raise


def load_table(
    df: DataFrame, table: str, if_exists: str = "fail", not_null: Sequence[str] = ()
) -> int:
    """Load a frame into a catalog table and return the rows written.

    A new or replacing table is written beside the old one, under a name of its
    own, and takes its place only when its row count agrees. Duplicates are kept.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {MODES}, not {if_exists!r}")
    require_table_name(table)
    rows = loadable(df, not_null)
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and if_exists == "fail":
        raise FileExistsError(f"table {table} exists; use if_exists='append' or 'replace'")
    counted, counter = _observed(rows)
    if exists and if_exists == "append":
        require_same_columns(spark.table(table).columns, rows.columns, table)
        counted.write.mode("append").insertInto(table)
        return counter.get["rows"]

    loading, old = _own_name(table, "loading"), _own_name(table, "old")
    try:
        counted.write.mode("errorifexists").format("parquet").saveAsTable(loading)
        written = counter.get["rows"]
        stored = spark.table(loading).count()
        if stored != written:
            raise RuntimeError(f"{table}: wrote {written} rows but stored {stored}")
        if exists:
            _swap(spark, table, loading, old)
            spark.sql(f"DROP TABLE {old}")
        else:
            _rename(spark, loading, table)
        return written
    finally:
        _discard(spark, loading)


def jdbc_table_exists(
    spark: SparkSession, url: str, table: str, properties: dict[str, str]
) -> bool:
    """Ask the database's own schema, in the dialect of MySQL."""
    schema, _, name = table.rpartition(".")
    schema = f"'{schema}'" if schema else "DATABASE()"
    found = (
        "(SELECT 1 AS found FROM information_schema.tables "
        f"WHERE table_schema = {schema} AND table_name = '{name}') AS t"
    )
    return not read_jdbc(spark, url, found, properties).isEmpty()


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    if_exists: str = "fail",
    batch_rows: int = BATCH_ROWS,
    not_null: Sequence[str] = (),
) -> int:
    """Load a frame into a database table and return the rows sent.

    Each partition is one transaction and a retried task sends its rows again:
    load into an empty table and compare its count with the returned one.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {MODES}, not {if_exists!r}")
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    require_table_name(table)
    rows = loadable(df, not_null)
    spark = df.sparkSession
    mode = "errorifexists"
    if jdbc_table_exists(spark, url, table, properties):
        if if_exists == "fail":
            raise FileExistsError(f"table {table} exists; use if_exists='append' or 'replace'")
        mode = "overwrite"
        if if_exists == "append":
            mode = "append"
            existing = read_jdbc(spark, url, table, properties).columns
            require_same_columns(existing, rows.columns, table)
    counted, counter = _observed(rows)
    options = {**properties, "batchsize": str(batch_rows)}
    counted.write.mode(mode).jdbc(url, table, properties=options)
    return counter.get["rows"]


def convert_table(
    spark: SparkSession,
    table: str,
    transform: Callable[[DataFrame], DataFrame],
    checks: Sequence[Callable[[DataFrame], None]] = (),
    keep_backup: bool = True,
    buckets: int | None = None,
    unique_keys: bool = False,
) -> int:
    """Replace a table by its converted form and return its rows.

    The converted rows go to a table of this attempt's own; counts (of footers, where tables are
    files) must agree and every check must pass on the written rows before the swap.
    ``unique_keys`` asks for complete and unique (uid, id): rows bucketed by the pair are
    checked while they are written, others are read once more. The original stays
    as ``<table>__backup``, and an existing backup is never overwritten. With
    ``buckets`` the new table is bucketed and sorted by (uid, id), so later joins
    on the pair need no shuffle; without it the table keeps the buckets it has.
    """
    require_table_name(table)
    shadow = _own_name(table, "new")
    backup = f"{table}__backup" if keep_backup else _own_name(table, "old")
    if spark.catalog.tableExists(backup):
        raise FileExistsError(f"{backup} exists; inspect or drop it first")
    source = spark.table(table)
    result = transform(source)
    layout = (buckets, list(KEYS), list(KEYS)) if buckets else bucketing(spark, table)
    checks = list(checks)
    if layout:
        result = result.repartition(layout[0], *layout[1])
    if unique_keys and layout and list(layout[1]) == list(KEYS):
        result, check_keys = observed_keys(result)
        checks.append(lambda _: check_keys())
    elif unique_keys:
        checks.append(require_unique_keys)
    writer = result.write.mode("errorifexists").format("parquet")
    if layout:
        writer = writer.bucketBy(layout[0], *layout[1])
        writer = writer.sortBy(*layout[2]) if layout[2] else writer
    try:
        writer.saveAsTable(shadow)
        before, after = source.count(), spark.table(shadow).count()
        if before != after:
            raise RuntimeError(f"{table} has {before} rows, its conversion {after}")
        for check in checks:
            check(spark.table(shadow))
        _swap(spark, table, shadow, backup)
    finally:
        _discard(spark, shadow)
    if not keep_backup:
        spark.sql(f"DROP TABLE {backup}")
    return after
