"""Row keys: what a row is grouped by when whole rows are compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
_MAX_PLAIN_COLUMNS = 4


def _encoded(df: DataFrame, name: str) -> Column:
    """One cell as text such that different cells never give the same text."""
    column = df[name]
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = (column + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    elif isinstance(kind, T.BinaryType):
        text = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(column))
    else:
        text = column.cast("string")
    marked = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(marked, F.lit("-"))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the named cells, length-prefixed: 32 bytes whatever the row's width.

    Grouping by it shuffles 32 bytes per row in place of whole texts.
    """
    return F.unhex(F.sha2(F.concat(*[_encoded(df, c) for c in columns]), 256))


def has_plain_keys(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the columns are few and of fixed width, their own best key."""
    kinds = [df.schema[c].dataType for c in columns]
    return len(columns) <= _MAX_PLAIN_COLUMNS and all(isinstance(kind, _FIXED_WIDTH) for kind in kinds)


def grouping_keys(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns to group by so that equal groups mean equal rows.

    A few fixed-width columns are their own best key; wide or text rows are grouped by
    their digest.
    """
    if has_plain_keys(df, columns):
        return [df[c].alias(f"key_{i}") for i, c in enumerate(columns)]
    return [row_digest(df, columns).alias("key_0")]


def value_key(value: Column) -> Column:
    """A text as itself when short, as its SHA-256 when longer than 32 bytes.

    The digest text is 64 bytes, so it can never equal a value kept as itself.
    """
    return F.when(F.octet_length(value) <= 32, value).otherwise(F.sha2(value, 256))
