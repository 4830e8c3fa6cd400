"""The first lines of many files, from their beginnings only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.sources.lines import file_heads, raw_lines
from sluicegate.sources.ranges import has_unknown_codec, list_files, readable, with_first_lines


def first_lines(
    spark: SparkSession, path: str | list[str], count: int, files: DataFrame | None = None
) -> DataFrame:
    """``files`` with ``heads``, the bytes of each file's first ``count`` lines that are not blank.

    ``files`` are those below ``path`` unless given, a table that is cheap to read again. Only
    the beginning of a file is read, as far as these lines go. Files in a store or a compression
    that Python cannot open are scanned by Spark instead.
    """
    ranged = readable(path)
    if files is None and ranged:
        files = list_files(spark, path)
    if ranged and not has_unknown_codec(files):
        return with_first_lines(files, count)
    lines = raw_lines(spark, path).where(F.col("block_start") == 0)
    heads = (
        file_heads(lines, count)
        .groupBy("file")
        .agg(F.sort_array(F.collect_list(F.struct("line_no", F.col("value").cast("binary").alias("line")))).alias("rows"))
        .select("file", F.col("rows.line").alias("heads"))
    )
    if files is None:
        files = lines.select("file", "file_size").distinct()
    none = F.array().cast("array<binary>")
    return files.join(heads, "file", "left").withColumn("heads", F.coalesce("heads", none))


def head_lines(spark: SparkSession, path: str | list[str], count: int) -> DataFrame:
    """(file, line_no, value): the first ``count`` non-blank lines of every file, numbered from 1."""
    heads = first_lines(spark, path, count)
    placed = heads.select("file", F.posexplode("heads").alias("place", "line"))
    return placed.select(
        "file", (F.col("place") + 1).cast("bigint").alias("line_no"), F.col("line").cast("string").alias("value")
    )
