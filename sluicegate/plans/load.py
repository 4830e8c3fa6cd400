"""From files to a checked table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators.cast import (
    BAD_LINE,
    SOURCE_FILE,
    TYPED,
    classify,
    good_rows,
    load_counts,
    mark_duplicate_keys,
    quarantine_rows,
)
from sluicegate.operators.infer import SPARK_TYPES, schema_report
from sluicegate.operators.tables import add_surrogate_id, next_id, write_table
from sluicegate.plans.analyze import detect_layout
from sluicegate.plans.mixed import data_columns, scan_mixed
from sluicegate.sources.delimited import FILE_ORDER, Layout, scan_delimited
from sluicegate.workspace import staging_path, stages_removed


def infer_types(
    rows: DataFrame, columns: Sequence[str], overrides: Mapping[str, str] | None = None
) -> tuple[dict[str, str], dict[str, bool]]:
    """Spark type and date order of every column: one pass, a few values per column returned.

    Bad lines have no say.
    """
    if BAD_LINE in rows.columns:
        rows = rows.where(F.col(BAD_LINE).isNull())
    report = schema_report(rows, columns, overrides).select(
        "column_name", "spark_type", "day_first"
    ).collect()
    types = {r.column_name: r.spark_type for r in report}
    return {c: types[c] for c in columns}, {r.column_name: r.day_first for r in report}


def stage_rows(
    classified: DataFrame, columns: Sequence[str], keep: Sequence[str], path: str
) -> DataFrame:
    """Classified rows written once to ``path``, good and bad ones apart.

    Text is kept for bad rows only; a filter on ``_is_bad`` reads one part.
    """
    spark = classified.sparkSession
    is_bad = F.col("error_type").isNotNull()
    text = [F.when(is_bad, F.col(f"`{c}`")).alias(c) for c in columns]
    typed = [c for c in classified.columns if c.startswith(TYPED)]
    rows = classified.select(
        *text, *[F.col(f"`{c}`") for c in typed], *keep, "error_type", "error_message",
        is_bad.cast("int").alias("_is_bad"),
    )
    rows.write.partitionBy("_is_bad").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def load_delimited(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    columns: Sequence[str] | None = None,
    layout: Layout | None = None,
    if_exists: str = "fail",
    on_bad_lines: str = "warn",
    types: Mapping[str, str] | None = None,
    overrides: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
    id_column: str | None = None,
    id_order: Sequence[str] = (),
    quarantine_path: str | None = None,
    quarantine_format: str = "json",
    day_first: Mapping[str, bool] | None = None,
    unique_key: Sequence[str] = (),
    mixed: bool = False,
) -> DataFrame:
    """Scan, infer, type, write, and set bad rows aside; returns the load statistics.

    Without ``layout`` it is detected, and with it the column names unless they are given.
    The counts are observed while the rows are written. Ids follow ``id_order``, or the order of
    the lines in the files, and go on after the largest one when rows are appended.
    The range sort behind them reads its input more than once, so the parsed rows are first
    staged in columnar form; whatever is staged is removed at the end. Without ids the bad rows are written in a second scan of the
    files, and only when there are any. With explicit ``types`` no inference pass runs.
    ``overrides`` fixes the SQL type of some columns and infers the rest. ``day_first`` tells
    per column whether dates like 03/04/2024 begin with the day; it goes before what is
    inferred, and columns without either are read day first. With ``mixed``, files may differ in
    layout and columns (:func:`sluicegate.plans.mixed.scan_mixed`); ``columns`` then names the
    columns of files without a header. An id column that the files
    already have loads as it is. Later rows of a ``unique_key`` are set aside.
    """
    if if_exists == "fail" and spark.catalog.tableExists(table):
        raise ValueError(f"table {table} already exists")
    with stages_removed(spark):
        counts = _load(
            spark, path, table, columns, layout, if_exists, on_bad_lines, types, overrides, required,
            id_column, id_order, quarantine_path, quarantine_format, day_first, unique_key, mixed,
        )
    total = counts["total_rows"]
    rate = counts["successful_rows"] * 100.0 / total if total else 0.0
    return spark.range(1, numPartitions=1).select(
        F.lit(table).alias("table_name"),
        F.lit(total).cast("bigint").alias("total_rows"),
        F.lit(counts["successful_rows"]).cast("bigint").alias("successful_rows"),
        F.lit(counts["failed_rows"]).cast("bigint").alias("failed_rows"),
        F.lit(f"{rate:.2f}%").alias("success_rate"),
        F.lit("Completed with errors" if counts["failed_rows"] else "Completed").alias("status"),
    )


def _load(
    spark, path, table, columns, layout, if_exists, on_bad_lines, types, overrides, required,
    id_column, id_order, quarantine_path, quarantine_format, day_first, unique_key, mixed,
) -> dict[str, int]:
    """The work of :func:`load_delimited`; returns its counts."""
    mixed_rows = scan_mixed(spark, path, columns or (), on_bad_lines) if mixed else None
    if mixed_rows is not None:
        columns = data_columns(mixed_rows)
    elif layout is None or columns is None:
        found, names = detect_layout(spark, path)
        layout = layout or found
        columns = columns or names
    if id_column is not None and id_column.lower() in (c.lower() for c in columns):
        id_column = None
    by_file = id_column is not None and not id_order
    rows = mixed_rows
    if rows is None:
        placed = by_file or bool(unique_key)
        rows = scan_delimited(spark, path, columns, layout, on_bad_lines, with_file=True, with_position=placed)
    orders: dict[str, bool] = {}
    if types is None:
        types, orders = infer_types(rows, columns, overrides)
    types = {c: SPARK_TYPES.get(t.upper(), t) for c, t in types.items()}
    classified = classify(rows, types, required, orders | dict(day_first or {}))
    if unique_key:
        # Places in the files are fixed before rows are compared by them.
        place = F.struct(*FILE_ORDER)
        fixed = stage_rows(classified, columns, FILE_ORDER, staging_path(spark, "load")).withColumn("_place", place)
        classified = mark_duplicate_keys(fixed, unique_key, "_place").drop("_place", "_is_bad")
    observed = Observation()
    counted = classified.observe(observed, *load_counts())
    if id_column is None:
        write_table(good_rows(counted, columns), table, if_exists)
        rejected = classified
    else:
        order = FILE_ORDER if by_file else list(id_order)
        kept = FILE_ORDER if by_file else [SOURCE_FILE]
        staged = stage_rows(counted, columns, kept, staging_path(spark, "load"))
        start = next_id(spark, table, id_column) if if_exists == "append" else 1
        good = good_rows(staged.where("_is_bad = 0"), columns, keep=FILE_ORDER if by_file else ())
        numbered = add_surrogate_id(good, order, id_column, start)
        write_table(numbered.select(id_column, *columns), table, if_exists)
        rejected = staged.where("_is_bad = 1")
    counts = observed.get
    if counts["failed_rows"] > 0 and quarantine_path is not None:
        bad = quarantine_rows(rejected, columns)
        bad.write.mode("append").partitionBy("source_file").format(quarantine_format).option(
            "header", True
        ).save(quarantine_path)
    return counts
