"""Encoding, separator and header of many files in one job each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.cells import is_number
from sluicegate.functions.patterns import (
    CONSISTENT_DELIMITERS,
    DEFAULT_DELIMITER,
    FREQUENT_DELIMITERS,
    HEAD_LINES,
)
from sluicegate.sources.heads import first_lines
from sluicegate.sources.lines import NUL, decode, raw_lines
from sluicegate.sources.ranges import list_files, readable
from sluicegate.workspace import staged

# Above this share of zero bytes a file is two bytes per character.
UTF16_NUL_SHARE = 0.2
COMPRESSED = r"(?i)\.(gz|bz2|zst|snappy|lz4|deflate)$"
_CANDIDATES = list(dict.fromkeys(CONSISTENT_DELIMITERS + FREQUENT_DELIMITERS))


def file_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, file_size) of every file, empty ones too; contents are not read.

    Tasks list the folders; only of a store that they cannot open, the list comes from the
    driver's own listing for a scan.
    """
    if readable(path):
        return list_files(spark, path)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size")
    )
    listed = spark.createDataFrame([(f,) for f in found.inputFiles()], "file string")
    # a listing writes scheme:///path where a scan writes scheme:/path
    listed = listed.select(F.regexp_replace("file", "^([a-z0-9]+):///", "$1:/").alias("file"))
    empty = listed.join(files, "file", "left_anti")
    return files.unionAll(empty.select("file", F.lit(0).cast("bigint")))


def encoding_report(
    spark: SparkSession, path: str | list[str], include_empty: bool = False
) -> DataFrame:
    """The encoding of every file, decided over all its bytes.

    Lines are tested where they are read and only counters leave a task, so a file of any
    size takes part split by split. A UTF-8 byte-order mark is dropped by the line reader;
    it shows as the bytes missing from the sum of the line lengths.
    """
    lines = raw_lines(spark, path)
    head = F.rpad(F.hex(F.substring(F.col("value").cast("binary"), 1, 4)), 8, "0")
    first_bytes = F.conv(head, 16, 10).cast("bigint")
    size = F.octet_length("value").cast("bigint")
    zeros = size - F.octet_length(F.replace(F.col("value"), F.lit(NUL), F.lit("")))
    at_start = F.when((F.col("block_start") == 0) & (size > 0), F.col("pos"))
    facts = lines.groupBy("file").agg(
        F.max("file_size").alias("file_size"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(size).alias("line_bytes"),
        F.sum(zeros).alias("zero_bytes"),
        F.bool_and(F.is_valid_utf8("value")).alias("valid"),
        F.min_by(first_bytes, at_start).alias("first_bytes"),
    )
    if include_empty:
        facts = file_list(spark, path).join(facts.drop("file_size"), "file", "left")
    hexed = F.lpad(F.hex("first_bytes"), 8, "0")
    dropped = F.col("file_size") - F.col("line_bytes") - F.col("lines")
    compressed = F.col("file").rlike(COMPRESSED)  # the size on disk says nothing of its lines
    mostly_zero = F.col("zero_bytes") > F.col("line_bytes") * F.lit(UTF16_NUL_SHARE)
    encoding = (
        F.when(F.col("lines").isNull(), "UTF-8")
        .when(hexed.startswith("FFFE"), "UTF-16LE")
        .when(hexed.startswith("FEFF"), "UTF-16BE")
        .when(mostly_zero & hexed.startswith("00"), "UTF-16BE")
        .when(mostly_zero, "UTF-16LE")
        .when(F.col("valid") & (dropped >= 2) & ~compressed, "UTF-8-SIG")
        .when(F.col("valid"), "UTF-8")
        .otherwise("ISO-8859-1")
    )
    return facts.select("file", "file_size", encoding.alias("encoding"))


def _heads(
    spark: SparkSession, path: str | list[str], include_empty: bool, lines: int = HEAD_LINES
) -> DataFrame:
    """(file, file_size, encoding, lines): each file's first non-blank lines as one array.

    The files are scanned once, for their encodings; what that finds, one row per file, is
    written down, and the first lines are read from the beginnings of these files.
    """
    report = staged(encoding_report(spark, path, include_empty), "encodings")
    text = F.transform("heads", lambda head: decode(head.cast("string"), F.col("encoding")))
    return first_lines(spark, path, lines, report).select("file", "file_size", "encoding", text.alias("lines"))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def _occurrences(delimiter: str) -> Column:
    """How often a separator stands on each of the lines in ``bare``."""
    return F.transform(
        "bare", lambda b: F.length(b) - F.length(F.replace(b, F.lit(delimiter), F.lit("")))
    )


def _with_delimiter(heads: DataFrame) -> DataFrame:
    """Add the separator voted for by the first lines of each file.

    The first candidate of the list that stands equally often on every line wins. Without one,
    the most frequent candidate does that fills less than half of the text, of equals the first
    of the list. Otherwise a comma. Quoted parts do not count.
    """
    bare = F.transform("lines", lambda line: F.regexp_replace(line, '"[^"]*"', ""))
    counted = heads.withColumn("bare", bare)
    counts = [_occurrences(d).alias(f"n{i}") for i, d in enumerate(_CANDIDATES)]
    size = _total(F.transform("bare", lambda b: F.length(b)))
    counted = counted.select("*", *counts, size.alias("size")).drop("bare")
    scores = []
    for i, d in enumerate(_CANDIDATES):
        n = F.col(f"n{i}")
        total = _total(n)
        steady = F.lit(d in CONSISTENT_DELIMITERS) & (F.array_min(n) == F.array_max(n)) & (total > 0)
        frequent = F.lit(d in FREQUENT_DELIMITERS) & (total > 0) & (total < F.col("size") / 2)
        level = F.when(steady, 2).when(frequent, 1).otherwise(0)
        ranked = F.when(level == 1, total).otherwise(0)
        scores.append(
            F.struct(level.alias("level"), ranked.alias("total"), F.lit(-i).alias("rank"),
                     F.lit(d).alias("delimiter"))
        )
    best = F.array_max(F.array(*scores))
    delimiter = F.when(best["level"] > 0, best["delimiter"]).otherwise(DEFAULT_DELIMITER)
    return counted.withColumn("delimiter", delimiter).drop("size", *[f"n{i}" for i in range(len(_CANDIDATES))])


def delimiter_report(
    spark: SparkSession, path: str | list[str], include_empty: bool = False
) -> DataFrame:
    """The separator of every file; a comma where the file has no text."""
    return _with_delimiter(_heads(spark, path, include_empty)).select("file", "delimiter")


def split_line(line: Column, sep: Column) -> Column:
    """The fields of one line, quotes respected and removed."""
    field = F.concat(
        F.lit("\\Q"), sep, F.lit('\\E("[^"]*(?:""[^"]*)*"|[^'), sep, F.lit("]*)")
    )
    fields = F.regexp_extract_all(F.concat(sep, line), field, F.lit(1))

    def unquote(x: Column) -> Column:
        quoted = (F.length(x) >= 2) & x.startswith('"') & x.endswith('"')
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.when(quoted, inner).otherwise(x)

    return F.transform(fields, unquote)


def _column_vote(first: Column, data: Column) -> Column:
    """One column's vote: 1 for a header, -1 against, 0 undecided.

    A column whose data are all numbers votes for when its first cell is not a number, and
    against when it is; a column whose data have one length and no number votes for when
    the first cell's length differs, and against when not.
    """
    numbers = F.size(F.filter(data, lambda cell: is_number(F.trim(cell))))
    lengths = F.transform(data, lambda cell: F.length(cell))
    even = (numbers == 0) & (F.array_min(lengths) == F.array_max(lengths))
    return (
        F.when(F.size(data) == 0, 0)
        .when(numbers == F.size(data), F.when(is_number(F.trim(first)), -1).otherwise(1))
        .when(even, F.when(F.length(first) != F.array_min(lengths), 1).otherwise(-1))
        .otherwise(0)
    )


def dialect_report(
    spark: SparkSession, path: str | list[str], include_empty: bool = False
) -> DataFrame:
    """Everything a scan needs to know, one row per file.

    (file, file_size, encoding, delimiter, has_header, num_columns, column_names). The
    first line is a header when the votes of its columns sum to more than zero; a file
    without lines is taken to have one.
    """
    voted = _with_delimiter(_heads(spark, path, include_empty))
    fields = F.transform("lines", lambda line: split_line(line, F.col("delimiter")))
    first = F.coalesce(F.get("fields", F.lit(0)), F.array().cast("array<string>"))
    rows = voted.withColumn("fields", fields).withColumn("first", first)
    rows = rows.withColumn("width", F.size("first"))
    data = F.filter(
        F.slice("fields", 2, HEAD_LINES), lambda cells: F.size(cells) == F.col("width")
    )
    rows = rows.withColumn("data", data)
    votes = F.transform(
        "first",
        lambda cell, i: _column_vote(
            cell, F.transform("data", lambda cells: F.get(cells, i))
        ),
    )
    positional = F.transform(
        "first", lambda cell, i: F.concat(F.lit("column_"), (i + 1).cast("string"))
    )
    has_header = (F.col("width") == 0) | (_total(votes) > 0)
    return rows.withColumn("has_header", has_header).select(
        "file",
        "file_size",
        "encoding",
        "delimiter",
        "has_header",
        F.col("width").cast("bigint").alias("num_columns"),
        F.when(F.col("has_header"), F.col("first")).otherwise(positional).alias("column_names"),
    )


def header_report(
    spark: SparkSession, path: str | list[str], include_empty: bool = False
) -> DataFrame:
    """Whether every file has a header, its number of columns and their names."""
    return dialect_report(spark, path, include_empty).select(
        "file", "has_header", "num_columns", "column_names"
    )


def column_set_diff(headers: DataFrame, target_columns: list[str]) -> DataFrame:
    """Columns each file lacks or adds against the target: (file, status, column_name)."""
    target = F.array(*[F.lit(c) for c in target_columns])
    names = F.col("column_names")

    def differing(status: str, found: Column) -> Column:
        return F.transform(
            found, lambda c: F.struct(F.lit(status).alias("status"), c.alias("column_name"))
        )

    both = F.concat(
        differing("common", F.array_intersect(target, names)),
        differing("missing", F.array_except(target, names)),
        differing("extra", F.array_except(names, target)),
    )
    return headers.select("file", F.inline(both))
