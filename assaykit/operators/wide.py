"""The wide label table: base columns, one label per item, split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from assaykit.functions.labels import range_label
from assaykit.operators.heavy import HEAVY_ROWS, SALT, measure, salted, without
from assaykit.schema import BASE_COLUMNS, KEYS, SPLIT_COLUMN, require_columns, require_double
from assaykit.sizing import BROADCAST_LIMIT, fits_broadcast
from assaykit.sources.cohort import distinct_keys

RANGE_COLUMNS = ["itemresult", "normallowvalue", "normalhighvalue"]


def require_label_names(names: Sequence[str]) -> None:
    """Labels must be named once each and must not hide a base column."""
    if not names:
        raise ValueError("at least one item table is needed")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"output columns named twice: {repeated}")
    taken = sorted(set(names) & {*[name for name, _ in BASE_COLUMNS], SPLIT_COLUMN})
    if taken:
        raise ValueError(f"output columns hide base columns: {taken}")


def item_label(item: DataFrame, name: str) -> DataFrame:
    """``uid, id, <label>`` of one typed item table; five columns are read."""
    require_columns(item.columns, [*KEYS, *RANGE_COLUMNS], f"item table for {name}")
    require_double(item, RANGE_COLUMNS, f"item table for {name}")
    return item.select(*KEYS, range_label(*[F.col(c) for c in RANGE_COLUMNS]).alias(name))


def label_wide(
    base: DataFrame,
    items: Sequence[tuple[DataFrame, str]],
    broadcast_base: bool = False,
    dealt: dict[int, tuple[int, int]] | None = None,
) -> DataFrame:
    """Base rows present in every item table, with their labels, ordered by key.

    All joins share the key, so each table is shuffled once and the joined rows
    are not shuffled again until the final sort; tables bucketed by the key are
    not shuffled at all.

    ``broadcast_base``: the base's keys were measured to be small. They first cut
    every item table down where it is read, and only matching rows are shuffled.

    ``dealt`` names heavy pairs by hash, as ``Measured.dealt`` does (table 0 is the base). Their
    rows are joined apart from the others: the table with the most rows of a pair deals them
    over several tasks, and the other tables repeat theirs for each.
    """
    names = [name for _, name in items]
    require_label_names(names)
    base_names = [name for name, _ in BASE_COLUMNS]
    require_columns(base.columns, [*base_names, SPLIT_COLUMN], "base table")
    labels = [item_label(item, name) for item, name in items]
    kept = base.select(*base_names, SPLIT_COLUMN)
    if broadcast_base:
        keys = distinct_keys(base)
        labels = [label.join(F.broadcast(keys), KEYS, "left_semi") for label in labels]
    tables = [kept, *labels]
    joined = _on([without(df, list(dealt or ())) for df in tables], KEYS)
    if dealt:
        apart = [salted(df, number, dealt) for number, df in enumerate(tables)]
        joined = joined.unionByName(_on(apart, [*KEYS, SALT]).drop(SALT))
    typed = [F.col(name).cast(kind).alias(name) for name, kind in BASE_COLUMNS]
    return joined.select(*typed, *names, F.col(SPLIT_COLUMN).cast("string")).orderBy(*KEYS)


def sized_label_wide(
    base: DataFrame,
    items: Sequence[tuple[DataFrame, str]],
    broadcast_limit: int = BROADCAST_LIMIT,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``label_wide`` with its choices made from one pass over the keys of all tables."""
    found = measure([base, *[item for item, _ in items]], heavy_rows)
    return label_wide(
        base,
        items,
        broadcast_base=fits_broadcast(found.key_bytes[0], broadcast_limit),
        dealt=found.dealt(heavy_rows),
    )


def _on(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(lambda left, right: left.join(right, list(keys), "inner"), tables)
