"""From text columns to the typed item table.

Every conversion is all or nothing: a value that does not fit raises inside the
write job, so no partly converted table can appear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from assaykit.functions.labels import sex_code
from assaykit.functions.numbers import finite_or_null, to_double
from assaykit.functions.text import blank_to_null
from assaykit.schema import (
    ID_LENGTH,
    ITEM_TABLE,
    KEYS,
    TEXT_BYTES,
    UID_LENGTH,
    require_columns,
)

# Fixed value: the only accepted spelling of a date.
DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
INCOMPLETE = " or ".join(f"{name} is null" for name in KEYS)
NUMBER = "__number"


def non_finite_to_null(df: DataFrame) -> DataFrame:
    """NaN and the infinities become NULL in every floating column."""
    floating = [
        f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    return df.withColumns({name: finite_or_null(F.col(name)) for name in floating})


def _converted(text: Column, kind: str, name: str, shape: str | None = None) -> Column:
    """Text to another type, or an error; the same whether or not the session is ANSI."""
    value = text.try_cast(kind)
    good = value.isNotNull() if shape is None else value.isNotNull() & text.rlike(shape)
    complaint = F.raise_error(F.concat(F.lit(f"{name} is no {kind}: "), text)).cast(kind)
    return F.when(text.isNull() | good, value).otherwise(complaint)


def _key(name: str, length: int) -> Column:
    trimmed = F.trim(F.col(name).cast("string"))
    return (
        F.when(trimmed.isNull(), F.raise_error(F.lit(f"{name} must not be NULL")).cast("string"))
        .when(F.char_length(trimmed) <= length, trimmed)
        .otherwise(F.raise_error(F.lit(f"{name} exceeds {length} characters")).cast("string"))
    )


def _date(name: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return _converted(blank_to_null(F.col(name)), "date", name, DATE_TEXT)


def _texts(names: list[str]) -> dict[str, Column]:
    """Text columns within the TEXT capacity, checked at once on the last of them.

    One check for all keeps the generated row method small enough to compile.
    """
    texts = {name: F.col(name).cast("string") for name in names}
    longest = F.greatest(F.lit(0), *[F.octet_length(text) for text in texts.values()])
    complaint = F.raise_error(F.lit(f"more than {TEXT_BYTES} bytes in one of {names}"))
    last = names[-1]
    texts[last] = F.when(longest <= TEXT_BYTES, texts[last]).otherwise(complaint.cast("string"))
    return texts


def convert_keys(df: DataFrame) -> DataFrame:
    """uid through itemname: trimmed keys, numbers, date, sex code; other columns unchanged."""
    names = [name for name, _ in ITEM_TABLE[:13]]
    require_columns(df.columns, names, "item table")
    dept = blank_to_null(F.col("deptid"))
    age = to_double(F.col("examage"), df.schema["examage"].dataType, "examage", nullable=True)
    converted = {
        "uid": _key("uid", UID_LENGTH),
        "id": _key("id", ID_LENGTH),
        "hospid": _converted(blank_to_null(F.col("hospid")), "bigint", "hospid"),
        "regdate": _date("regdate", df.schema["regdate"].dataType),
        "examage": F.coalesce(age, F.lit(0.0)),
        "usex": sex_code(F.col("usex")),
        "deptid": to_double(dept, T.StringType(), "deptid", nullable=True),
    }
    return df.withColumns({**converted, **_texts([n for n in names if n not in converted])})


def convert_result(df: DataFrame) -> DataFrame:
    """itemresult to a double that is never NULL."""
    col, kind = F.col("itemresult"), df.schema["itemresult"].dataType
    return df.withColumn("itemresult", to_double(col, kind, "itemresult", nullable=False))


def convert_normals(df: DataFrame) -> DataFrame:
    """Both bounds of the normal range to nullable doubles, together."""
    return df.withColumns(
        {
            name: to_double(F.col(name), df.schema[name].dataType, name, nullable=True)
            for name in ["normallowvalue", "normalhighvalue"]
        }
    )


def convert_unit(df: DataFrame) -> DataFrame:
    """itemindexresultunit to nullable text of at most the TEXT capacity."""
    return df.withColumns(_texts(["itemindexresultunit"]))


def to_item_table(df: DataFrame) -> DataFrame:
    """All conversions at once, in the item table's column order."""
    require_columns(df.columns, [name for name, _ in ITEM_TABLE], "item table")
    typed = convert_unit(convert_normals(convert_result(convert_keys(df))))
    return typed.select(*[name for name, _ in ITEM_TABLE])


def duplicate_keys(df: DataFrame) -> DataFrame:
    """``uid, id, rows`` of every pair that occurs more than once.

    Counted before the shuffle: a hot pair costs one row per task.
    """
    pairs = df.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    return pairs.where("rows > 1")


def _refuse_keys(most: int, incomplete: int) -> None:
    if most > 1:
        raise ValueError(f"(uid, id) must be unique and not NULL; one pair occurs {most} times")
    if incomplete:
        raise ValueError("(uid, id) must be unique and not NULL; a part is NULL")


def require_unique_keys(df: DataFrame) -> None:
    """(uid, id) must be complete and unique; one shuffle of the pairs."""
    pairs = df.groupBy(*KEYS).agg(F.count("*").alias("rows"))
    found = pairs.agg(
        F.coalesce(F.max("rows"), F.lit(0)).alias("most"), F.count_if(F.expr(INCOMPLETE)).alias("incomplete")
    ).first()
    _refuse_keys(found["most"], found["incomplete"])


def observed_keys(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, and a check of their keys to make once they are written.

    For rows that lie together by (uid, id): each row is numbered among the rows of its pair,
    where the sort that the write needs as well brings them together, so the check reads nothing again and
    shuffles nothing. Repeats of a task change no maximum.
    """
    seen = Observation()
    number = F.row_number().over(Window.partitionBy(*KEYS).orderBy(*KEYS))
    numbered = df.withColumn(NUMBER, number).observe(
        seen,
        F.coalesce(F.max(NUMBER), F.lit(0)).alias("most"),
        F.count_if(F.expr(INCOMPLETE)).alias("incomplete"),
    )
    return numbered.drop(NUMBER), lambda: _refuse_keys(seen.get["most"], seen.get["incomplete"])
