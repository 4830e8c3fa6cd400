"""Finding out how a file set is written and what it holds, without loading it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators.infer import schema_report
from sluicegate.plans.mixed import file_layouts
from sluicegate.sources.delimited import Layout, scan_delimited
from sluicegate.workspace import stages_removed


def layouts(dialects: DataFrame) -> DataFrame:
    """The distinct layouts of a file set with their files and bytes."""
    return dialects.groupBy("encoding", "delimiter", "has_header", "column_names").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("file_size").alias("total_bytes")
    )


def detect_layout(spark: SparkSession, path: str | list[str]) -> tuple[Layout, list[str]]:
    """The layout shared by all files, and their column names made safe for a table.

    A file that holds nothing but the header of the others is read like them, one without a line
    of text has no say (:func:`sluicegate.plans.mixed.file_layouts`).
    Files that are written differently cannot be one scan: that raises, and
    :func:`sluicegate.sources.dialect.dialect_report` tells which files differ.
    """
    with stages_removed(spark):
        files = file_layouts(spark, path).withColumnRenamed("names", "column_names")
        found = layouts(files).orderBy(F.desc("file_count")).limit(2).collect()
    if len(found) != 1:
        raise ValueError(
            "no files with text" if not found else "the files do not share one layout: "
            + "; ".join(f"{r.encoding} {r.delimiter!r} {r.column_names}" for r in found)
        )
    row = found[0]
    return Layout(sep=row.delimiter, encoding=row.encoding, header=row.has_header), list(row.column_names)


def analyze_files(
    spark: SparkSession, path: str | list[str], overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """The schema report of a file set, with the layout it was read by."""
    layout, columns = detect_layout(spark, path)
    rows = scan_delimited(spark, path, columns, layout, on_bad_lines="skip")
    return schema_report(rows, columns, overrides).select(
        "*",
        F.lit(layout.encoding).alias("encoding"),
        F.lit(layout.sep).alias("delimiter"),
        F.lit(layout.header).alias("has_header"),
    )
