"""Digests of a table's content that do not depend on the order of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

ROWS = "rows"


def content_digest(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates that equal multisets of rows share: their number, and the sum and the
    exclusive or of two 64-bit hashes of the given columns.

    A changed, lost, added or exchanged value changes them but for a chance of about 2^-64. A
    value is hashed with whether it is null, which a hash of values alone would pass over.
    """
    parts = [p for name in sorted(columns) for p in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    one, two = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    return [
        F.count("*").alias(ROWS),
        F.sum(one.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(two).alias("xor"),
    ]


def observed_digest(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The frame, whose digest is taken while it is written: behind the last shuffle, where a
    retried task does not count twice."""
    seen = Observation()
    return df.observe(seen, *content_digest(df, columns)), seen


def require_same_content(seen: Observation, stored: DataFrame, columns: Sequence[str], what: str) -> int:
    """Compare what was written with what is read back, and return the rows."""
    written = seen.get
    found = stored.agg(*content_digest(stored, columns)).first().asDict()
    if found[ROWS] != written[ROWS]:
        raise RuntimeError(f"{what}: wrote {written[ROWS]} rows but stored {found[ROWS]}")
    if found != {name: written[name] for name in found}:
        raise RuntimeError(f"{what}: the stored rows are not those that were written")
    return found[ROWS]
