"""What lies in a folder: sizes, extensions and estimated row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.names import table_name_from_path
from sluicegate.functions.sizes import size_text
from sluicegate.sources.dialect import file_list
from sluicegate.sources.lines import raw_lines
from sluicegate.sources.ranges import has_unknown_codec, readable, with_sample


#: Bytes at the beginning of a file that its mean line is taken from.
SAMPLE_BYTES = 100_000


def file_inventory(
    spark: SparkSession, path: str | list[str], estimate_rows: bool = True
) -> DataFrame:
    """Size, extension, table name and estimated rows of every file.

    The mean line is taken from the first ``SAMPLE_BYTES`` bytes of a file; rows are its size
    over that mean: 0 for an empty file, 1 where no line ends, else at least 1. Without
    ``estimate_rows`` only the listing is read and the estimate is NULL.
    """
    files = file_list(spark, path)
    if not estimate_rows:
        return _described(files, F.lit(None).cast("bigint"))
    if readable(path) and not has_unknown_codec(files):
        sampled = with_sample(files, SAMPLE_BYTES)
        counted = sampled.select(
            "file", "file_size", F.get("sampled", F.lit(0)).alias("bytes"), F.get("sampled", F.lit(1)).alias("ends")
        )
    else:  # Spark's scans count the lines of the first split
        lines = raw_lines(spark, path).where(F.col("block_start") == 0)
        ends = lines.groupBy("file").agg(
            F.count(F.lit(1)).alias("ends"), F.sum(F.octet_length("value").cast("bigint") + 1).alias("bytes")
        )
        counted = files.join(ends, "file", "left")
    estimate = F.expr("(cast(file_size AS decimal(19,0)) * cast(ends AS decimal(18,0))) div bytes")
    rows = (
        F.when(F.col("file_size") == 0, 0)
        .when(F.coalesce("ends", F.lit(0)) == 0, 1)
        .otherwise(F.greatest(estimate, F.lit(1)))
    )
    return _described(counted, rows.cast("bigint"))


def _described(files: DataFrame, rows: Column) -> DataFrame:
    decoded = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    return files.select(
        "file",
        F.lower(F.regexp_extract("file", r"\.([^./]*)$", 1)).alias("extension"),
        table_name_from_path(decoded).alias("table_name"),
        "file_size",
        size_text(F.col("file_size")).alias("size_text"),
        rows.alias("estimated_rows"),
    )
