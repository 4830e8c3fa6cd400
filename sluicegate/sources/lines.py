"""Lines of many files at once, and the first lines of each file."""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.workspace import few_listing_tasks

NUL = "\u0000"


def raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line with its file, the start of its split and a position.

    ``value`` holds the bytes as they are in the file, whatever its encoding; lines are cut
    at the byte of a line feed. ``pos`` grows with the line number inside one split.
    """
    with few_listing_tasks(spark):
        lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def _is_blank(value: Column) -> Column:
    return F.trim(F.translate(value, NUL + "\r\t", "")) == ""


def file_heads(lines: DataFrame, count: int) -> DataFrame:
    """The first ``count`` non-blank lines of every file, numbered from 1.

    Only each file's first split takes part, and the rank filter is applied before the
    shuffle, so at most ``count`` lines per file move.
    """
    order = Window.partitionBy("file").orderBy("pos")
    return (
        lines.where((F.col("block_start") == 0) & ~_is_blank(F.col("value")))
        .withColumn("line_no", F.row_number().over(order))
        .where(F.col("line_no") <= count)
        .withColumn("line_no", F.col("line_no").cast("bigint"))
    )


_LINE_ENCODINGS = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "ascii": "UTF-8",
    "iso8859-1": "ISO-8859-1",
    "utf-16": "UTF-16",
    "utf-16-le": "UTF-16LE",
    "utf-16-be": "UTF-16BE",
}


def line_encoding(name: str) -> str:
    """The name under which :func:`decode` knows an encoding, any alias allowed; others raise."""
    try:
        known = _LINE_ENCODINGS.get(codecs.lookup(name).name)
    except LookupError:
        known = None
    if known is None:
        raise ValueError(f"lines in {name} cannot be read one by one")
    return known


def decode(value: Column, encoding: Column) -> Column:
    """The bytes of one line as text.

    A UTF-16 line cut at the line-feed byte carries half of the line feed: little-endian
    lines start with it, big-endian lines end with it. A byte-order mark is dropped.
    """
    raw = value.cast("binary")
    size = F.octet_length(value)
    odd = size % 2 == 1
    starts_nul = F.substring(value, 1, 1) == NUL
    little = F.when(odd & starts_nul, F.substring(raw, F.lit(2), size)).otherwise(raw)
    big = F.when(odd, F.substring(raw, F.lit(1), size - 1)).otherwise(raw)
    name = F.upper(encoding)
    text = (
        F.when(name == "UTF-16LE", F.decode(little, "UTF-16LE"))
        .when(name.isin("UTF-16", "UTF-16BE"), F.decode(big, "UTF-16BE"))
        .when(name == "ISO-8859-1", F.decode(raw, "ISO-8859-1"))
        .otherwise(value)
    )
    return F.rtrim(F.regexp_replace(text, "^\ufeff", ""), F.lit("\r"))
