"""Predicates and conversions for one text cell, all JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicegate.functions import patterns as P


def missing_to_null(value: Column, tokens: Sequence[str] = tuple(P.MISSING_TOKENS)) -> Column:
    """Turn the texts that stand for a missing value into NULL."""
    return F.when(~value.isin(*tokens), value)


def is_integer(value: Column) -> Column:
    return value.rlike(P.INTEGER)


def is_number(value: Column) -> Column:
    return value.rlike(P.NUMBER)


def is_boolean(value: Column) -> Column:
    return F.lower(value).isin("true", "false")


def has_date_prefix(value: Column) -> Column:
    return value.rlike(P.any_prefix(P.DATE_PREFIXES))


def has_time_prefix(value: Column) -> Column:
    return value.rlike(P.any_prefix(P.TIME_PREFIXES))


def is_email(value: Column) -> Column:
    # the cheap test comes first, so most cells never reach the pattern
    return F.contains(value, F.lit("@")) & value.rlike(P.EMAIL)


def is_phone(value: Column) -> Column:
    return F.length(value).between(7, 21) & value.rlike(P.PHONE)


def _iso_head(value: Column) -> Column:
    return F.substring(value, 1, 10).try_cast("date")


def _local_head(value: Column, day_first: bool) -> Column:
    first, second, year = (F.substring(value, at, n) for at, n in ((1, 2), (4, 2), (7, 4)))
    month, day = (second, first) if day_first else (first, second)
    # in ISO order the cast rejects an impossible date without raising
    return F.concat_ws("-", year, month, day).try_cast("date")


def iso_date(value: Column) -> Column:
    """The date in the first ten characters when they read year-month-day."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), _iso_head(value))


def local_date(value: Column, day_first: bool) -> Column:
    """The date in the first ten characters written day/month/year or month/day/year.

    ``/``, ``-`` and ``.`` are all accepted between the parts.
    """
    return F.when(value.rlike(r"^\d{2}([/.-])\d{2}\1\d{4}"), _local_head(value, day_first))


def date_of_prefixed(value: Column, day_first: bool) -> Column:
    """The same date for a value already known to have a date prefix: no pattern needed."""
    iso = F.substring(value, 5, 1) == "-"
    return F.when(iso, _iso_head(value)).otherwise(_local_head(value, day_first))


def any_date(value: Column, day_first: bool) -> Column:
    return F.coalesce(iso_date(value), local_date(value, day_first))


def clock_part(value: Column) -> Column:
    """What follows the ten date characters."""
    return F.substring(value, 11, 1 << 30)


def text_bucket(max_length: Column) -> Column:
    """The text type that holds values up to ``max_length`` characters."""
    bucket = None
    for limit, name in P.TEXT_BUCKETS:
        fits = max_length <= limit
        bucket = F.when(fits, name) if bucket is None else bucket.when(fits, name)
    return bucket.otherwise(P.LONG_TEXT)
