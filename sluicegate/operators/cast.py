"""Text rows to typed rows, with the rows that do not fit set aside.

A row is classified once: *malformed_row* (too many fields), *cast_error* (a value that
does not read as its column's type), *null_violation* (a required value is missing) or
*duplicate_key* (a later row of a key). Good and bad rows together are always all rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import cells as C
from sluicegate.functions import patterns as P
from sluicegate.functions.sizes import two_decimals

BAD_LINE = "_bad_line"
SOURCE_FILE = "source_file"
TYPED = "_typed_"
ERROR_TYPES = ["malformed_row", "cast_error", "null_violation", "duplicate_key"]
_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def convert(value: Column, kind: str, day_first: bool = True) -> Column:
    """A text cell as ``kind``, or NULL when it does not read as one.

    ``time`` gives the text ``HH:mm:ss``. Never raises, whatever the ANSI setting.
    """
    kind = kind.lower()
    if kind == "string":
        return value
    if kind == "boolean":
        return F.when(F.lower(value) == "true", True).when(F.lower(value) == "false", False)
    if kind in _INTEGRAL or kind.endswith(",0)"):
        return F.when(C.is_integer(value), value.try_cast(kind))
    if kind in ("float", "double") or kind.startswith("decimal"):
        return F.when(C.is_number(value), value.try_cast(kind))
    if kind == "date":
        return F.when(F.length(value) == 10, C.any_date(value, day_first))
    if kind in ("timestamp_ntz", "timestamp"):
        clock = C.clock_part(value)
        day = C.any_date(value, day_first).cast("string")
        stamp = F.when(clock == "", day).when(
            clock.rlike(P.CLOCK_SUFFIX), F.concat(day, F.lit(" "), F.substring(clock, 2, 1 << 30))
        )
        return stamp.try_cast(kind)
    if kind == "time":
        clock = F.when(F.length(value) == 5, F.concat(value, F.lit(":00"))).otherwise(value)
        return F.when(clock.rlike(P.CLOCK), clock)
    raise ValueError(f"no conversion to {kind}")


def _cell(name: str) -> Column:
    return C.missing_to_null(F.col(f"`{name}`"))


def _typed(name: str, kind: str, day_first: Mapping[str, bool]) -> Column:
    return convert(_cell(name), kind, day_first.get(name, True))


def typed_cast(
    df: DataFrame, types: Mapping[str, str], day_first: Mapping[str, bool] | None = None
) -> DataFrame:
    """The columns of ``types`` converted; what does not convert becomes NULL."""
    return df.select(*[_typed(c, kind, day_first or {}).alias(c) for c, kind in types.items()])


def classify(
    df: DataFrame,
    types: Mapping[str, str],
    required: Sequence[str] = (),
    day_first: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Add ``error_type`` and ``error_message`` to text rows; both are NULL on good rows.

    The converted values stay beside the text, so good rows are converted once. The two
    error columns come out of a generator: a filter on them is then not pushed below the
    conversions, where every mention would convert again.
    """
    converted = df.select(
        "*", *[_typed(c, kind, day_first or {}).alias(TYPED + c) for c, kind in types.items()]
    )
    failed = [
        F.when(
            _cell(c).isNotNull() & F.col(f"`{TYPED}{c}`").isNull(),
            F.concat(F.lit(f"{c}: cannot read '"), F.col(f"`{c}`"), F.lit(f"' as {kind}")),
        )
        for c, kind in types.items()
        if kind != "string"
    ]
    missing = [F.when(_cell(c).isNull(), F.lit(f"{c}: missing")) for c in required]
    nothing = F.lit(None).cast("string")
    line = F.col(BAD_LINE) if BAD_LINE in df.columns else nothing
    bad_cast = F.coalesce(*failed) if failed else nothing
    bad_null = F.coalesce(*missing) if missing else nothing
    marked = converted.select("*", bad_cast.alias("_cast"), bad_null.alias("_null"))
    error = F.struct(
        F.when(line.isNotNull(), "malformed_row")
        .when(F.col("_cast").isNotNull(), "cast_error")
        .when(F.col("_null").isNotNull(), "null_violation")
        .alias("error_type"),
        F.coalesce(F.concat(F.lit("too many fields: "), line), "_cast", "_null").alias(
            "error_message"
        ),
    )
    return marked.select("*", F.inline(F.array(error))).drop("_cast", "_null")


def mark_duplicate_keys(classified: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """Mark every good row but the first of its key as ``duplicate_key``.

    Keys are compared as they load, by their converted values; a row with a missing key
    repeats nothing. ``position`` is a unique, stable row order. The first position of a repeated key comes
    from one map-side aggregate; rows then meet at most one such key, so no pairs form, and
    a hot key can be split over tasks by adaptive skew handling.
    """
    typed = [F.col(f"`{TYPED}{c}`" if TYPED + c in classified.columns else f"`{c}`") for c in key]
    names = [f"_key_{i}" for i in range(len(key))]
    rows = classified.withColumns(dict(zip(names, typed, strict=True)))
    first = (
        rows.where(F.col("error_type").isNull())
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(position).alias("_first"))
        .where(F.col("_copies") > 1)
        .drop("_copies")
    )
    joined = rows.join(first, names, "left")
    later = F.col("error_type").isNull() & (F.col(position) > F.col("_first"))
    return (
        joined.withColumn(
            "error_message",
            F.when(later, F.lit("repeated key: " + ",".join(key))).otherwise(F.col("error_message")),
        )
        .withColumn("error_type", F.when(later, "duplicate_key").otherwise(F.col("error_type")))
        .select(*classified.columns)
    )


def good_rows(
    classified: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The rows without an error, typed; columns of ``keep`` come along as they are."""
    good = classified.where(F.col("error_type").isNull())
    return good.select(*[F.col(f"`{TYPED}{c}`").alias(c) for c in columns], *keep)


def loaded_and_rejected(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row typed as far as it converts, with ``is_good`` telling which ones load."""
    return classified.select(
        F.col("error_type").isNull().alias("is_good"),
        *[F.col(f"`{TYPED}{c}`").alias(c) for c in columns],
    )


def quarantine_rows(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows with an error, as text, with type, message, time and file."""
    bad = classified.where(F.col("error_type").isNotNull())
    file = F.col(SOURCE_FILE) if SOURCE_FILE in classified.columns else F.lit(None).cast("string")
    return bad.select(
        *[F.col(f"`{c}`") for c in columns],
        "error_type",
        "error_message",
        F.current_timestamp().alias("error_timestamp"),
        file.alias(SOURCE_FILE),
    )


def error_stats(classified: DataFrame) -> DataFrame:
    """Rows per error type."""
    return (
        classified.where(F.col("error_type").isNotNull())
        .groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("error_count"))
    )


def load_counts() -> list[Column]:
    """The counters of a load, usable in an aggregate or an Observation."""
    good = F.col("error_type").isNull()
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(good).alias("successful_rows"),
        F.count_if(~good).alias("failed_rows"),
    ]


def load_stats(classified: DataFrame) -> DataFrame:
    """Totals, success rate and final status of a load, in one row."""
    rate = F.coalesce(F.expr("try_divide(successful_rows * 100.0D, total_rows)"), F.lit(0.0))
    return classified.agg(*load_counts()).select(
        "total_rows",
        "successful_rows",
        "failed_rows",
        F.concat(two_decimals(rate), F.lit("%")).alias("success_rate"),
        F.when(F.col("failed_rows") == 0, "Completed")
        .otherwise("Completed with errors")
        .alias("status"),
    )


def load_report(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals, errors by type and missing values of the good rows: (section, subject, value).

    One aggregate over the load, whatever the number of columns; error types that do not
    occur have no row.
    """
    good = F.col("error_type").isNull()
    errors = [F.count_if(F.col("error_type") == e).alias(e) for e in ERROR_TYPES]
    nulls = [
        F.count_if(good & F.col(f"`{TYPED}{c}`").isNull()).alias(f"n{i}")
        for i, c in enumerate(columns)
    ]

    def row(section: str, subject: str, counter: str) -> Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(subject).alias("subject"), F.col(counter).alias("value")
        )

    rows = [row("load", c, c) for c in ("total_rows", "successful_rows", "failed_rows")]
    rows += [row("error", e, e) for e in ERROR_TYPES]
    rows += [row("null", c, f"n{i}") for i, c in enumerate(columns)]
    counted = classified.agg(*load_counts(), *errors, *nulls)
    return counted.select(F.inline(F.array(*rows))).where(
        (F.col("section") != "error") | (F.col("value") > 0)
    )
