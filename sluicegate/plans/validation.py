"""All checks of a table in one report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators import validate as V
from sluicegate.operators.profile import (
    exact_sum,
    is_missing,
    numeric_columns,
    one_pass,
    present,
)
from sluicegate.operators.reconcile import sample_comparison

REPORT = "test string, status string, message string, metric string, value double, detail string"
SAMPLE_ROWS = 5
GROUPS = 10


def _result(
    test: Column | str,
    status: Column | str,
    message: Column | str,
    metric: Column | str,
    value: Column,
    detail: Column | None = None,
) -> list[Column]:
    def text(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return [
        text(test).alias("test"),
        text(status).alias("status"),
        text(message).alias("message"),
        text(metric).alias("metric"),
        value.cast("double").alias("value"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    ]


def _table_exists(spark: SparkSession, exists: bool) -> DataFrame:
    return spark.range(1, numPartitions=1).select(
        *_result(
            "table_exists",
            "Passed" if exists else "Failed",
            "table found" if exists else "table not found",
            "exists",
            F.lit(1.0 if exists else 0.0),
        )
    )


COUNT, NULLS, STATS = "row_count", "null_values", "column_stats"


def profile_checks(
    df: DataFrame, expected: int | None = None, tests: Sequence[str] = (COUNT, NULLS, STATS)
) -> DataFrame:
    """Row count, missing values and numeric statistics of all columns, from one aggregate."""
    numeric = set(numeric_columns(df)) if STATS in tests else set()

    def fact(make):
        nothing = F.max(F.lit(None).cast("double"))
        return lambda c: make(c) if c in numeric else nothing

    counted = NULLS in tests or STATS in tests
    report = one_pass(
        df,
        df.columns,
        {
            "nulls": lambda c: F.count_if(is_missing(df, c)) if counted else F.max(F.lit(0)),
            "min": fact(lambda c: F.min(present(df, c)).cast("double")),
            "max": fact(lambda c: F.max(present(df, c)).cast("double")),
            "sum": fact(lambda c: exact_sum(df, c).cast("double")),
        },
        {"total": F.count(F.lit(1))},
    )
    report = report.withColumn("avg", F.expr("try_divide(`sum`, total - nulls)"))
    goal = F.lit(expected).cast("bigint")
    status = F.when(goal.isNull(), "Info").when(F.col("total") == goal, "Passed").otherwise("Failed")
    message = (
        F.when(goal.isNull(), "no expected count")
        .when(F.col("total") == goal, "row count matches")
        .otherwise("row count differs")
    )
    name = F.col("column_name")
    rows = []
    if COUNT in tests:
        once = F.when(F.col("position") == 1, COUNT)
        rows.append(_result(once, status, message, "actual_count", F.col("total")))
    if NULLS in tests:
        rows.append(_result(NULLS, "Info", "missing values", name, F.col("nulls")))
    is_numeric = F.when(name.isin(*numeric), STATS) if numeric else F.lit(None).cast("string")
    rows += [
        _result(is_numeric, "Info", "numeric column", F.concat(name, F.lit(f".{f}")), F.col(f))
        for f in (("min", "max", "avg", "sum") if numeric else ())
    ]
    laid_out = report.select(F.inline(F.array(*[F.struct(*r) for r in rows])))
    return laid_out.where(F.col("test").isNotNull())


def sample_check(df: DataFrame, order_by: Sequence[str] | None) -> DataFrame:
    """The first rows of the table as JSON, in the given order or as they come."""
    ordered = df.orderBy(*order_by) if order_by else df
    rows = ordered.limit(SAMPLE_ROWS).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
    listed = rows.agg(F.collect_list("row").alias("rows")).select(F.posexplode("rows").alias("place", "row"))
    name = F.concat(F.lit("row "), (F.col("place") + 1).cast("string"))
    return listed.select(*_result("sample_data", "Info", "sample row", name, F.lit(None), F.col("row")))


def duplicate_check(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """How many rows repeat another, and the most repeated groups with their values as JSON."""
    message = F.when(F.col("status") == "Passed", "no repeated rows").otherwise("repeated rows")
    total = V.duplicate_total(df, columns).select(
        *_result("duplicates", F.col("status"), message, "extra_rows", F.col("extra_rows"))
    )
    groups = V.duplicate_groups(df, columns, GROUPS)
    values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in groups.columns[:-1]]))
    entry = F.struct((-F.col("copies")).alias("most"), values.alias("values"))
    listed = groups.agg(F.sort_array(F.collect_list(entry)).alias("groups")).select(
        F.posexplode("groups").alias("place", "group")
    )
    name = F.concat(F.lit("group "), (F.col("place") + 1).cast("string"))
    return total.unionAll(
        listed.select(*_result("duplicates", "Info", "repeated group", name, -F.col("group.most"), F.col("group.values")))
    )


COUNTS, COLUMNS, SAMPLES = "source_counts", "source_columns", "source_samples"


def source_counts(source: DataFrame, df: DataFrame) -> DataFrame:
    """Row counts of both sides; Passed when they agree and the table has all columns of the source."""
    message = F.when(F.col("rows_match"), "row counts match").otherwise("row counts differ")
    both = [
        F.struct(*_result("csv_comparison", F.col("status"), message, "source_rows", F.col("source_rows"))),
        F.struct(*_result("csv_comparison", "Info", message, "table_rows", F.col("table_rows"))),
    ]
    return V.compare_status(source, df).select(F.inline(F.array(*both)))


def source_columns(source: DataFrame, df: DataFrame) -> DataFrame:
    """Columns that only one side has."""
    have, given = {c.lower() for c in df.columns}, {c.lower() for c in source.columns}
    rows = [("csv_comparison", "Info", "column missing in the table", c, None, None) for c in source.columns if c.lower() not in have]
    rows += [("csv_comparison", "Info", "column not in the source", c, None, None) for c in df.columns if c.lower() not in given]
    return df.sparkSession.createDataFrame(rows, REPORT)


def source_samples(source: DataFrame, df: DataFrame, order_by: Sequence[str] | None) -> DataFrame:
    """Whether the first values of every common column agree, with both sides' values as JSON.

    First is by ``order_by``, else by all common columns.
    """
    have = {c.lower(): c for c in df.columns}
    common = [c for c in source.columns if c.lower() in have]
    if not common:
        return df.sparkSession.createDataFrame([], REPORT)
    renamed = df.select(*[F.col(f"`{have[c.lower()]}`").alias(c) for c in common])
    order = [c for c in (order_by or common) if c in common] or common
    compared = sample_comparison(source.select(*common), renamed, order, SAMPLE_ROWS, common)
    message = F.when(F.col("match"), "first values match").otherwise("first values differ")
    both = F.concat(F.lit('{"source":'), F.col("source_sample"), F.lit(',"table":'), F.col("table_sample"), F.lit("}"))
    return compared.select(
        *_result("csv_comparison", "Info", message, F.concat("column_name", F.lit(".first")), F.col("match").cast("int"), both)
    )


def _checks(df, source, expected, duplicate_columns, order_by):
    """Name and maker of every check; what shares a name in the report fails apart."""
    checks = [
        ("profile", lambda: profile_checks(df, expected)),
        ("sample_data", lambda: sample_check(df, order_by)),
        ("duplicates", lambda: duplicate_check(df, duplicate_columns)),
    ]
    if source is not None:
        checks += [
            (COUNTS, lambda: source_counts(source, df)),
            (COLUMNS, lambda: source_columns(source, df)),
            (SAMPLES, lambda: source_samples(source, df, order_by)),
        ]
    return checks


def _with_overall(results: DataFrame) -> DataFrame:
    overall = results.agg(V.overall_status(F.col("status")).alias("status")).select(
        *_result("overall", F.col("status"), "most severe status", "overall", F.lit(None))
    )
    return results.unionAll(overall)


def validation_report(
    df: DataFrame,
    source: DataFrame | None = None,
    expected: int | None = None,
    duplicate_columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Every check and the overall status as one lazy DataFrame of results.

    Besides counts and statistics: the first rows, the most repeated groups, columns that only
    one side has, and whether the first values of both sides agree, in ``detail`` as JSON.
    """
    parts = [_table_exists(df.sparkSession, True)]
    parts += [make() for _, make in _checks(df, source, expected, duplicate_columns, order_by)]
    results = parts[0]
    for part in parts[1:]:
        results = results.unionAll(part)
    return _with_overall(results)


def _attempt(name: str, make) -> list[tuple]:
    """The result rows of one check, or one Error row."""
    try:
        return [tuple(r) for r in make().collect()]
    except PySparkException as error:
        test = "csv_comparison" if name in (COUNTS, COLUMNS, SAMPLES) else name
        return [(test, "Error", str(error).splitlines()[0], name, None, None)]


def validate_table(
    spark: SparkSession,
    table: str,
    source: DataFrame | None = None,
    expected: int | None = None,
    duplicate_columns: Sequence[str] | None = None,
    save_to: str | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Run every check on a catalog table; a check that breaks is reported as Error.

    The checks share one aggregate where they can; if that breaks, they are tried one by one, so
    that the others still report. A missing table gives Failed and nothing else. Only results, a
    few rows per column, come to the driver. ``save_to`` writes the report as JSON.
    """
    if not spark.catalog.tableExists(table):
        report = _with_overall(_table_exists(spark, False))
    else:
        rows = [tuple(r) for r in _table_exists(spark, True).collect()]
        df = spark.table(table)
        for name, make in _checks(df, source, expected, duplicate_columns, order_by):
            outcome = _attempt(name, make)
            if name == "profile" and any(r[1] == "Error" for r in outcome):  # find out which of the three broke
                outcome = []
                for test in (COUNT, NULLS, STATS):
                    outcome += _attempt(test, lambda test=test: profile_checks(df, expected, [test]))
            rows += outcome
        report = _with_overall(spark.createDataFrame(rows, REPORT))
    if save_to is not None:
        report.write.mode("overwrite").json(save_to)
    return report
