"""Schema inference from text columns over the whole data.

Cells are laid out as (column, value) rows and reduced to one row of counts per column:
one scan, one map-side aggregate with fixed-width buffers, and an expression whose size
does not depend on the number of columns. A type is chosen only when every value present
converts to it, so no value is lost to a sample that missed it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import cells as C
from sluicegate.functions import patterns as P
from sluicegate.operators.cast import convert

# SQL type of the report -> Spark type of the table.
SPARK_TYPES = {
    "BOOLEAN": "boolean",
    "INT": "int",
    "BIGINT": "bigint",
    "BIGINT UNSIGNED": "decimal(20,0)",
    "DOUBLE": "double",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIME": "time",
}
# Further SQL types that an override may name; DECIMAL, CHAR and VARCHAR take their numbers.
OVERRIDE_TYPES = SPARK_TYPES | {
    "TINYINT": "tinyint",
    "SMALLINT": "smallint",
    "INTEGER": "int",
    "FLOAT": "float",
    "TIMESTAMP": "timestamp_ntz",
    "TEXT": "string",
    "LONGTEXT": "string",
    "STRING": "string",
}
INT_MIN, INT_MAX = -(2**31), 2**31 - 1
UINT64_MAX = str(2**64 - 1)


def spark_type_of(sql_type: str) -> str:
    """The Spark type of a SQL type given by name, in any case; unknown types raise."""
    name = " ".join(sql_type.upper().split())
    if re.fullmatch(r"(VAR)?CHAR ?\(\d+\)", name):
        return "string"
    number = re.fullmatch(r"(?:DECIMAL|NUMERIC)(?: ?\( ?(\d+) ?(?:, ?(\d+) ?)?\))?", name)
    if number:
        precision, scale = int(number[1] or 10), int(number[2] or 0)
        if scale <= precision <= 38 and precision:
            return f"decimal({precision},{scale})"
    if name not in OVERRIDE_TYPES:
        raise ValueError(f"unknown type {sql_type!r}")
    return OVERRIDE_TYPES[name]


def _lookup(entries: Mapping[str, str], key: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return F.try_element_at(pairs, key)


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("position"),
            F.lit(c).alias("column_name"),
            C.missing_to_null(df[c].cast("string")).alias("value"),
        )
        for i, c in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*entries)))


def column_facts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts per column from which every inference below is decided.

    Cheap shape tests gate the parsing of dates, and each parse is done once per cell.
    """
    columns = list(columns) if columns is not None else df.columns
    v = F.col("value")
    dated, whole = F.col("dated"), F.col("is_integer")
    shaped = _cells(df, columns).select("*", C.is_integer(v).alias("is_integer"))
    shaped = shaped.select(
        "*",
        F.when(whole, False).otherwise(C.has_date_prefix(v)).alias("dated"),
        F.when(whole, False).otherwise(C.has_time_prefix(v)).alias("timed"),
    )
    parsed = shaped.select(
        "*",
        F.when(whole, F.expr("try_cast(value AS bigint)")).alias("as_long"),
        F.when(dated, C.date_of_prefixed(v, True)).isNotNull().alias("day_first_date"),
        F.when(dated, C.date_of_prefixed(v, False)).isNotNull().alias("month_first_date"),
        F.when(dated, C.clock_part(v)).alias("clock"),
    )
    # a CASE, not AND: only cells beyond 64 bits reach the decimal cast
    wide = F.expr("try_cast(value AS decimal(20,0))")
    unsigned = F.when(F.col("as_long").isNotNull(), F.col("as_long") >= 0).when(
        whole, wide.between(F.lit(0), F.lit(UINT64_MAX).cast("decimal(20,0)"))
    )
    alone = F.col("clock") == ""
    with_clock = alone | F.col("clock").rlike(P.CLOCK_SUFFIX)
    count = F.count_if
    return parsed.groupBy("position", "column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(v).alias("present"),
        count(F.when(F.length(v) <= 5, C.is_boolean(v))).alias("booleans"),
        F.count("as_long").alias("longs"),
        F.min("as_long").alias("min_long"),
        F.max("as_long").alias("max_long"),
        count(unsigned).alias("unsigned"),
        count(F.when(whole, True).otherwise(C.is_number(v))).alias("numbers"),
        count(F.col("day_first_date") & alone).alias("dates_day_first"),
        count(F.col("month_first_date") & alone).alias("dates_month_first"),
        count(F.col("day_first_date") & with_clock).alias("stamps_day_first"),
        count(F.col("month_first_date") & with_clock).alias("stamps_month_first"),
        count(F.when(F.col("timed"), convert(v, "time").isNotNull())).alias("times"),
        count(dated).alias("date_prefixes"),
        count("timed").alias("time_prefixes"),
        count(C.is_email(v)).alias("emails"),
        count(C.is_phone(v)).alias("phones"),
        F.max(F.length(v)).cast("bigint").alias("max_length"),
    )


def _all(name: str) -> Column:
    return F.col(name) == F.col("present")


def _is_numeric() -> Column:
    return _all("booleans") | _all("longs") | _all("unsigned") | _all("numbers")


def _sql_type() -> Column:
    fits_int = (F.col("min_long") >= INT_MIN) & (F.col("max_long") <= INT_MAX)
    return (
        F.when(F.col("present") == 0, "TEXT")
        .when(_all("booleans"), "BOOLEAN")
        .when(_all("longs") & fits_int, "INT")
        .when(_all("longs"), "BIGINT")
        .when(_all("unsigned"), "BIGINT UNSIGNED")
        .when(_all("numbers"), "DOUBLE")
        .when(_all("dates_day_first") | _all("dates_month_first"), "DATE")
        .when(_all("stamps_day_first") | _all("stamps_month_first"), "DATETIME")
        .when(_all("times"), "TIME")
        .when(_all("emails"), "VARCHAR(100)")
        .when(_all("phones"), "VARCHAR(20)")
        .otherwise(C.text_bucket(F.col("max_length")))
    )


def _semantic_type() -> Column:
    return (
        F.when((F.col("present") == 0) | _is_numeric(), F.lit(None).cast("string"))
        .when(_all("date_prefixes"), "date")
        .when(_all("time_prefixes"), "time")
        .when(_all("emails"), "email")
        .when(_all("phones"), "phone")
    )


def _spark_type(sql_type: Column) -> Column:
    return F.coalesce(_lookup(SPARK_TYPES, sql_type), F.lit("string"))


def infer_column_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The narrowest type every value of a column converts to."""
    return column_facts(df, columns).select("position", "column_name", _sql_type().alias("sql_type"))


def infer_nullability(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whether a column holds a missing value anywhere."""
    columns = list(columns) if columns is not None else df.columns
    return (
        _cells(df, columns)
        .groupBy("position", "column_name")
        .agg(F.count_if(F.col("value").isNull()).alias("null_count"))
        .select("position", "column_name", "null_count", (F.col("null_count") > 0).alias("nullable"))
    )


def infer_varchar_bucket(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The text type that holds the longest value; TEXT when all are missing."""
    columns = list(columns) if columns is not None else df.columns
    longest = (
        _cells(df, columns)
        .groupBy("position", "column_name")
        .agg(F.max(F.length("value")).cast("bigint").alias("max_length"))
    )
    bucket = F.when(F.col("max_length").isNull(), "TEXT").otherwise(
        C.text_bucket(F.col("max_length"))
    )
    return longest.select("position", "column_name", "max_length", bucket.alias("bucket"))


def infer_semantic_type(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """date, time, email or phone when every value has that form; NULL for plain columns."""
    return column_facts(df, columns).select(
        "position", "column_name", _semantic_type().alias("semantic_type")
    )


def likely_datetime(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Date-time when one pattern fits over 70 % of the values, or every value parses."""
    columns = list(columns) if columns is not None else df.columns
    # every pattern starts with two digits, so most text is settled by one test
    digits = F.when(F.col("value").rlike(r"^\d{2}"), F.col("value"))
    hits = [
        F.count_if(digits.rlike(P.any_prefix([p]))).alias(f"p{i}")
        for i, p in enumerate(P.DATETIME_PREFIXES)
    ]
    parses = F.expr("try_cast(value AS timestamp)").isNotNull()  # a time alone parses too
    counted = (
        _cells(df, columns)
        .groupBy("position", "column_name")
        .agg(F.count("value").alias("present"), F.count_if(parses).alias("parsed"), *hits)
    )
    best = F.greatest(*[F.col(f"p{i}") for i in range(len(hits))])
    likely = (F.col("present") > 0) & (
        (best > F.col("present") * F.lit(P.DATETIME_SHARE)) | (F.col("parsed") == F.col("present"))
    )
    return counted.select("position", "column_name", likely.alias("likely_datetime"))


def likely_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric when every value is a number once commas and spaces are gone."""
    columns = list(columns) if columns is not None else df.columns
    plain = F.translate(F.col("value"), ", ", "")
    counted = (
        _cells(df, columns)
        .groupBy("position", "column_name")
        .agg(F.count("value").alias("present"), F.count_if(C.is_number(plain)).alias("numbers"))
    )
    likely = (F.col("present") > 0) & (F.col("numbers") == F.col("present"))
    return counted.select("position", "column_name", likely.alias("likely_numeric"))


def schema_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    overrides: Mapping[str, str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """The inferred schema as rows: position, name, types, nullability, longest value.

    ``overrides`` fixes the SQL type of named columns; types and columns that do not exist
    raise. ``key`` marks the key column; when
    no such column exists a leading ``id`` row stands for the surrogate key.
    """
    columns = list(columns) if columns is not None else df.columns
    sql_type = _sql_type()
    spark_type = _spark_type(F.col("sql_type"))
    if overrides:
        unknown = sorted(set(overrides) - set(columns))
        if unknown:
            raise ValueError(f"no column {', '.join(unknown)} to override")
        fixed = {c: spark_type_of(t) for c, t in overrides.items()}
        sql_type = F.coalesce(_lookup({c: t.upper() for c, t in overrides.items()}, F.col("column_name")), sql_type)
        spark_type = F.coalesce(_lookup(fixed, F.col("column_name")), spark_type)
    has_day_first = F.greatest("dates_day_first", "stamps_day_first")
    has_month_first = F.greatest("dates_month_first", "stamps_month_first")
    is_key = F.col("column_name").eqNullSafe(F.lit(key))
    report = column_facts(df, columns).withColumn("sql_type", sql_type).select(
        "position",
        "column_name",
        "sql_type",
        spark_type.alias("spark_type"),
        ((F.col("present") < F.col("row_count")) & ~is_key).alias("nullable"),
        _semantic_type().alias("semantic_type"),
        "max_length",
        is_key.alias("is_key"),
        (has_day_first >= has_month_first).alias("day_first"),
    )
    if key is not None and key not in columns:
        surrogate = df.sparkSession.sql(
            "SELECT 0L AS position, 'id' AS column_name, 'BIGINT' AS sql_type, "
            "'bigint' AS spark_type, false AS nullable, CAST(NULL AS string) AS semantic_type, "
            "CAST(NULL AS bigint) AS max_length, true AS is_key, true AS day_first"
        )
        report = surrogate.unionAll(report)
    return report
