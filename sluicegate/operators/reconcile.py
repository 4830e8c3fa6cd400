"""Comparing a table with its source, row by row.

Both comparisons are signed unions grouped by key or by row: no join, so repeated keys
never multiply into pairs and map-side aggregation absorbs a key that holds a third of
the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions.rows import row_digest

OUTCOMES = ["same", "changed", "only_source", "only_target"]


def _shared(source: DataFrame, target: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    apart = set(source.columns) ^ set(target.columns)
    if apart:
        raise ValueError(f"only one side has {', '.join(sorted(apart))}; say which columns to compare")
    return list(source.columns)


def key_outcomes(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key value with its outcome.

    A key is *same* when both sides hold equal rows for it equally often, *changed* when
    both hold it but the rows differ, else it is on one side only.
    """
    key = list(key)
    compared = [c for c in _shared(source, target, columns) if c not in key]

    def side(df: DataFrame, from_source: int) -> DataFrame:
        digest = row_digest(df, compared) if compared else F.lit(None).cast("binary")
        return df.select(
            *[df[c] for c in key], digest.alias("row_key"), F.lit(from_source).alias("from_source")
        )

    per_row = (
        side(source, 1)
        .unionAll(side(target, 0))
        .groupBy(*key, "row_key")
        .agg(
            F.count_if(F.col("from_source") == 1).alias("in_source"),
            F.count_if(F.col("from_source") == 0).alias("in_target"),
        )
    )
    outcome = (
        F.when(F.col("target_rows") == 0, "only_source")
        .when(F.col("source_rows") == 0, "only_target")
        .when(F.col("differing") == 0, "same")
        .otherwise("changed")
    )
    return (
        per_row.groupBy(*key)
        .agg(
            F.sum("in_source").alias("source_rows"),
            F.sum("in_target").alias("target_rows"),
            F.count_if(F.col("in_source") != F.col("in_target")).alias("differing"),
        )
        .select(*key, "source_rows", "target_rows", outcome.alias("outcome"))
    )


def reconcile_by_key(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Number of keys that are the same, changed, or on one side only."""
    counted = key_outcomes(source, target, key, columns).agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    )
    entries = [F.struct(F.lit(o).alias("outcome"), F.col(o).alias("key_count")) for o in OUTCOMES]
    return counted.select(F.inline(F.array(*entries)))


def reconcile_multiset(
    source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows that one side holds more often than the other, with both surpluses.

    Empty exactly when the two sides are equal as multisets. First the digests of all rows are
    balanced, which moves 32 bytes a row; then only rows whose digest is out of balance are
    fetched, one of each.
    """
    columns = _shared(source, target, columns)
    rows = source.select(*columns, F.lit(1).alias("_sign")).unionAll(target.select(*columns, F.lit(-1).alias("_sign")))
    digests = row_digest(rows, columns)  # of both sides in the types they have together
    balance = (
        rows.select(digests.alias("_digest"), "_sign")
        .groupBy("_digest")
        .agg(F.sum("_sign").alias("_balance"))
        .where(F.col("_balance") != 0)
    )
    held = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    wide = rows.select(digests.alias("_digest"), F.struct(*held).alias("_row")).join(balance, "_digest")
    one = wide.groupBy("_digest").agg(F.first("_row").alias("_row"), F.first("_balance").alias("_balance"))
    return one.select(
        *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(columns)],
        F.greatest("_balance", F.lit(0)).cast("bigint").alias("extra_in_source"),
        F.greatest(-F.col("_balance"), F.lit(0)).cast("bigint").alias("extra_in_target"),
    )


def sample_comparison(
    source: DataFrame,
    target: DataFrame,
    order_by: Sequence[str],
    rows: int = 5,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Whether the first ``rows`` values of every common column agree, in key order.

    Both sides are top-k sorts, so only ``rows`` rows per side meet; missing values
    compare equal to missing values.
    """
    columns = _shared(source, target, columns)

    def first_rows(df: DataFrame, side: str) -> DataFrame:
        head = df.select(*dict.fromkeys([*order_by, *columns])).orderBy(*order_by).limit(rows)
        row = F.struct(
            *[F.col(c) for c in order_by],
            *[F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(columns)],
        )
        return head.select(F.lit(side).alias("side"), row.alias("row"))

    # at most ``rows`` rows a side meet in one aggregate, as one array per side in key order
    samples = first_rows(source, "s").unionAll(first_rows(target, "t")).agg(
        *[F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("row")))).alias(s) for s in "st"]
    )

    def values(side: str, i: int) -> Column:
        return F.col(side)[f"t{i}"]

    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.to_json(values("s", i)).alias("source_sample"),
            F.to_json(values("t", i)).alias("table_sample"),
            values("s", i).eqNullSafe(values("t", i)).alias("match"),
        )
        for i, c in enumerate(columns)
    ]
    return samples.select(F.inline(F.array(*entries)))
