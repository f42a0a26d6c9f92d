"""Text decoding, trimming and naming."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def strict_utf8(col: Column) -> Column:
    """Decode bytes as UTF-8; a malformed sequence fails the job, NULL stays NULL."""
    return F.validate_utf8(col.cast("string"))


def as_text(col: Column, data_type: T.DataType) -> Column:
    """Text as it stands, bytes decoded strictly, anything else formatted."""
    if isinstance(data_type, T.BinaryType):
        return strict_utf8(col)
    return col if isinstance(data_type, T.StringType) else col.cast("string")


def strip_whitespace(col: Column) -> Column:
    """Remove Unicode whitespace and the separator controls from both ends."""
    blank = r"[\p{IsWhite_Space}\x1c-\x1f]+"
    return F.regexp_replace(col, f"^{blank}|{blank}$", "")


def blank_to_null(col: Column) -> Column:
    """Space-trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col.cast("string")), F.lit(""))


def is_blank(col: Column) -> Column:
    """Present but empty after trimming spaces; a tab is not blank."""
    return F.trim(col.cast("string")) == ""


def path_safe(col: Column) -> Column:
    """Replace the characters that would change a path: slash, backslash, NUL."""
    return F.translate(col, "/\\\0", "___")


def item_filename(name: Column, code: Column) -> Column:
    return F.concat(path_safe(name), F.lit("__"), path_safe(code), F.lit(".parquet"))


def decode_path(col: Column) -> Column:
    """Undo percent-encoding without turning a plus sign into a space."""
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))
