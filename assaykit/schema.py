"""Column names and types shared by every stage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, types as T

# The raw detail table's columns.
KEYS = ["uid", "id"]
RESULT_COLUMNS = ["itemresult", "normalhighvalue", "normallowvalue"]
RAW_REQUIRED = RESULT_COLUMNS + ["itemcode", "rn"]

# The typed item table, in column order.
ITEM_TABLE = [
    ("uid", "string"),
    ("id", "string"),
    ("hospid", "bigint"),
    ("hospname", "string"),
    ("regdate", "date"),
    ("examage", "double"),
    ("usex", "string"),
    ("deptid", "double"),
    ("dept", "string"),
    ("checkitemcode", "string"),
    ("checkitemname", "string"),
    ("itemcode", "string"),
    ("itemname", "string"),
    ("itemresult", "double"),
    ("normalhighvalue", "double"),
    ("normallowvalue", "double"),
    ("itemindexresultunit", "string"),
]
UID_LENGTH = 32
ID_LENGTH = 18
TEXT_BYTES = 65_535

# The wide export's columns around the labels.
BASE_COLUMNS = [
    ("uid", "string"),
    ("id", "string"),
    ("hospid", "bigint"),
    ("usex", "string"),
    ("examage", "double"),
    ("image_path_1", "string"),
    ("image_path_2", "string"),
]
SPLIT_COLUMN = "split"


def require_columns(present: Iterable[str], needed: Iterable[str], what: str) -> None:
    """Fail before any job runs when a needed column is absent."""
    missing = sorted(set(needed) - set(present))
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}")


def require_unique_names(names: Sequence[str]) -> None:
    """Table columns must differ in more than letter case."""
    if not names:
        raise ValueError("a table needs at least one column")
    folded = [name.casefold() for name in names]
    clashes = sorted({name for name in names if folded.count(name.casefold()) > 1})
    if clashes:
        raise ValueError(f"column names differ only in letter case: {clashes}")


def require_flat(schema: T.StructType) -> None:
    """Tables take scalar columns only; nothing is serialised silently."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    for field in schema:
        if isinstance(field.dataType, nested):
            raise TypeError(
                f"column {field.name!r} has the nested type "
                f"{field.dataType.simpleString()}, which tables do not take"
            )


def require_double(df: DataFrame, columns: Iterable[str], what: str) -> None:
    """Range labels compare numbers; text would compare character by character."""
    for name in columns:
        found = df.schema[name].dataType
        if not isinstance(found, T.DoubleType):
            raise TypeError(
                f"{what}: column {name!r} is {found.simpleString()}, convert it to double first"
            )
