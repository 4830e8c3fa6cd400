"""Checks on a loaded table, each a DataFrame of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions.patterns import STATUSES
from sluicegate.functions.rows import grouping_keys, has_plain_keys
from sluicegate.operators.profile import duplicate_row_count


def data_columns(df: DataFrame, id_column: str | None = "id") -> list[str]:
    """All columns but the surrogate id, which would make every row unique."""
    return [c for c in df.columns if c != id_column]


def check_row_count(df: DataFrame, expected: int | None = None) -> DataFrame:
    """Row count against an expected number: Passed, Failed, or Info when none is given."""
    goal = F.lit(expected).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("actual_count")).select(
        "actual_count",
        goal.alias("expected_count"),
        F.when(goal.isNull(), "Info")
        .when(F.col("actual_count") == goal, "Passed")
        .otherwise("Failed")
        .alias("status"),
    )


def duplicate_groups(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int = 10
) -> DataFrame:
    """The ``limit`` most repeated values of the given columns, with their counts.

    Rows are counted by a digest where their columns are wide. Values are fetched for the groups
    that reach the smallest count of the list only; ties go to the smaller values.
    """
    columns = list(columns) if columns is not None else data_columns(df)
    keys = grouping_keys(df, columns)
    names = [f"key_{i}" for i in range(len(keys))]
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    least = repeated.orderBy(F.desc("copies")).limit(limit).agg(F.min("copies")).scalar()
    near = repeated.where(F.col("copies") >= least)
    if has_plain_keys(df, columns):
        values = near.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], "copies")
    else:
        held = F.struct(*[df[c].alias(f"c{i}") for i, c in enumerate(columns)])
        rows = df.select(keys[0], held.alias("row")).join(near, "key_0")
        one = rows.groupBy("key_0").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
        values = one.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)], "copies")
    return values.orderBy(F.desc("copies"), *[F.asc(c) for c in columns]).limit(limit)


def duplicate_total(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one: Passed when none do, else Warning."""
    columns = list(columns) if columns is not None else data_columns(df)
    return duplicate_row_count(df, columns).select(
        "duplicate_groups",
        "rows_in_groups",
        "extra_rows",
        F.when(F.col("duplicate_groups") == 0, "Passed").otherwise("Warning").alias("status"),
    )


def compare_row_counts(source: DataFrame, table: DataFrame) -> DataFrame:
    """Row counts of both sides and whether they agree.

    The two sides are tagged and counted in one aggregate, so neither count waits for the
    other.
    """
    sides = source.select(F.lit(1).alias("from_source")).unionAll(
        table.select(F.lit(0).alias("from_source"))
    )
    return sides.agg(
        F.count_if(F.col("from_source") == 1).alias("source_rows"),
        F.count_if(F.col("from_source") == 0).alias("table_rows"),
    ).select(
        "source_rows",
        "table_rows",
        (F.col("source_rows") == F.col("table_rows")).alias("rows_match"),
    )


def compare_status(source: DataFrame | None, table: DataFrame) -> DataFrame:
    """Passed when counts agree and the table has every source column, else Warning.

    Without a source the comparison is Skipped.
    """
    if source is None:
        return table.sparkSession.range(1, numPartitions=1).select(
            F.lit(None).cast("bigint").alias("source_rows"),
            F.lit(None).cast("bigint").alias("table_rows"),
            F.lit(None).cast("boolean").alias("rows_match"),
            F.lit(None).cast("bigint").alias("missing_columns"),
            F.lit("Skipped").alias("status"),
        )
    missing = len({c.lower() for c in source.columns} - {c.lower() for c in table.columns})
    complete = F.lit(missing == 0)
    return compare_row_counts(source, table).select(
        "*",
        F.lit(missing).cast("bigint").alias("missing_columns"),
        F.when(F.col("rows_match") & complete, "Passed").otherwise("Warning").alias("status"),
    )


def quality_gate(
    df: DataFrame,
    ok: Column,
    min_success_rate: float = 95.0,
    required: Sequence[str] = (),
    unique_key: Sequence[str] = (),
) -> DataFrame:
    """Rules over the rows of a load: success rate, required columns, unique key.

    ``ok`` marks the rows that loaded. The rate and all required columns share one
    aggregate; the unique key needs a grouping of its own.
    """
    rate = F.coalesce(
        F.expr("try_divide(good * 100.0D, total)"), F.lit(0.0)
    )
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("good"),
        *[F.count_if(ok & df[c].isNull()).alias(f"n{i}") for i, c in enumerate(required)],
    )

    def rule(name: str, subject: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"),
            F.lit(subject).alias("subject"),
            value.cast("double").alias("value"),
            F.when(passed, "Passed").otherwise("Failed").alias("status"),
        )

    rules = [rule("success_rate", "rows", F.round(rate, 2), rate >= F.lit(float(min_success_rate)))]
    rules += [
        rule("not_null", c, F.col(f"n{i}"), F.col(f"n{i}") == 0) for i, c in enumerate(required)
    ]
    report = counted.select(F.inline(F.array(*rules)))
    if unique_key:
        extra = duplicate_row_count(df.where(ok), list(unique_key))
        unique = rule("unique_key", ",".join(unique_key), F.col("extra_rows"), F.col("extra_rows") == 0)
        report = report.unionAll(extra.select(F.inline(F.array(unique))))
    return report


def overall_status(statuses: Column) -> Column:
    """The most severe status in a group of results; Info and Skipped do not count."""
    order = F.array(*[F.lit(s) for s in STATUSES])
    severity = F.array_position(order, statuses)
    worst = F.min(F.when(severity > 0, severity))
    return F.get(order, F.coalesce(worst, F.lit(len(STATUSES))).cast("int") - 1)
