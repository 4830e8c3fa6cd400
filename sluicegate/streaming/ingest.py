"""Incremental loading of a folder of delimited files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate.operators.cast import SOURCE_FILE, TYPED, classify
from sluicegate.sources.delimited import Layout, apply_bad_line_policy, csv_reader


def placed_stream(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    layout: Layout,
    files_per_batch: int,
    on_bad_lines: str,
) -> DataFrame:
    """The cells of files as they come, with their file and the start of their split."""
    if layout.header and layout.header_row > 0 or not layout.skip_blank_lines:
        raise ValueError("a stream reads files with the header on top and skips blank lines")
    rows = (
        csv_reader(spark.readStream, columns, layout)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    rows = rows.select(
        *rows.columns,
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("_block_start"),
    )
    return apply_bad_line_policy(rows, columns, layout, on_bad_lines)


def ingest_incremental(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    types: Mapping[str, str],
    layout: Layout = Layout(),
    required: Sequence[str] = (),
    files_per_batch: int = 1000,
    day_first: Mapping[str, bool] | None = None,
    on_bad_lines: str = "warn",
) -> StreamingQuery:
    """Load the files of ``path`` that were not loaded before, then stop.

    Files are taken in micro-batches and committed by the exactly-once file sink, so a run
    that dies is resumed from the checkpoint without losing or repeating rows. Good and
    bad rows go to the ``is_bad=false`` and ``is_bad=true`` parts of the target in one parse:
    converted values for good rows, text for bad ones (:func:`loaded_rows`,
    :func:`rejected_rows`).
    """
    rows = placed_stream(spark, path, list(types), layout, files_per_batch, on_bad_lines)
    classified = classify(rows, types, required, day_first)
    bad = F.col("error_type").isNotNull()
    marked = classified.select(
        *[F.when(~bad, F.col(f"`{TYPED}{c}`")).alias(TYPED + c) for c in types],
        *[F.when(bad, F.col(f"`{c}`")).alias(c) for c in types],
        "error_type",
        "error_message",
        SOURCE_FILE,
        bad.alias("is_bad"),
    )
    return (
        marked.writeStream.format("parquet")
        .partitionBy("is_bad")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


def _target(spark: SparkSession, target: str, types: Mapping[str, str]) -> DataFrame:
    """What was loaded so far; nothing loaded is an empty table."""
    typed = [f"`{TYPED}{c}` {'string' if t.lower() == 'time' else t}" for c, t in types.items()]
    text = [f"`{c}` string" for c in types]
    rest = ["error_type string", "error_message string", f"{SOURCE_FILE} string", "is_bad boolean"]
    return spark.read.schema(", ".join([*typed, *text, *rest])).parquet(target)


def loaded_rows(spark: SparkSession, target: str, types: Mapping[str, str]) -> DataFrame:
    """The good rows of an incremental load, typed."""
    good = _target(spark, target, types).where(~F.col("is_bad"))
    return good.select(*[F.col(f"`{TYPED}{c}`").alias(c) for c in types])


def rejected_rows(spark: SparkSession, target: str, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The bad rows of an incremental load, as text with their error."""
    bad = _target(spark, target, dict.fromkeys(columns, "string")).where("is_bad")
    return bad.select(*[F.col(f"`{c}`") for c in columns], "error_type", "error_message", SOURCE_FILE)
