"""Scanning delimited files into text columns.

Files are read as text cells by Spark's own CSV reader, in splits; typing is a separate
step, so that one bad value costs a row and not a column.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.operators.cast import BAD_LINE, SOURCE_FILE
from sluicegate.sources.heads import head_lines
from sluicegate.sources.lines import decode, file_heads, line_encoding, raw_lines
from sluicegate.sources.ranges import codec_of, has_unknown_codec, list_files, range_lines, readable
from sluicegate.workspace import staging_path

_RAW = "_raw_line"
# Together these give every row its place in the file set.
FILE_ORDER = [SOURCE_FILE, "_block_start", "_position"]


@dataclass(frozen=True)
class Layout:
    """How a file set is written.

    ``header_row`` counts non-blank lines from 0. ``multiline`` allows line breaks inside
    quotes and makes a file one task, so it is off unless a file needs it; UTF-16 files are cut
    into ranges like others.
    """

    sep: str = ","
    encoding: str = "UTF-8"
    header: bool = True
    header_row: int = 0
    quote: str = '"'
    multiline: bool = False
    skip_blank_lines: bool = True


def positional_names(count: int) -> list[str]:
    """Names of the columns of a file without header."""
    return [f"column_{i}" for i in range(1, count + 1)]


def _csv_options(layout: Layout) -> dict[str, str]:
    return {
        "sep": layout.sep,
        "quote": layout.quote,
        "escape": layout.quote,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _RAW,
    }


def _schema(columns: Sequence[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in [*columns, _RAW]]
    return T.StructType(fields)


def _split(line: str, columns: Sequence[str], layout: Layout) -> Column:
    """The cells of a line as columns.

    A generator of one row, so that a later filter on a cell does not parse the line again.
    """
    cells = F.from_csv(line, _schema(columns).toDDL(), _csv_options(layout))
    return F.inline(F.array(cells))


def split_cells(line: Column, width: int, layout: Layout) -> Column:
    """The first ``width`` cells of a line as an array."""
    names = [f"c{i}" for i in range(width)]
    options = {k: v for k, v in _csv_options(layout).items() if k != "columnNameOfCorruptRecord"}
    cells = F.from_csv(line, ", ".join(f"{n} string" for n in names), options)
    # bound once, so that the line is split once and not for every cell
    return F.get(F.transform(F.array(cells), lambda row: F.array(*[row[n] for n in names])), F.lit(0))


def fields_in(line: Column, layout: Layout) -> Column:
    """Number of fields of a line, separators inside quotes not counted.

    As for the reader, a quote opens a quoted field only where the field begins; any other
    quote is a letter.
    """
    q, sep = re.escape(layout.quote), re.escape(layout.sep)
    bare = F.regexp_replace(line, f"(^|{sep})[ \\t]*{q}(?:[^{q}]|{q}{q})*+{q}", "$1")
    gone = F.replace(bare, F.lit(layout.sep), F.lit(""))
    return (F.length(bare) - F.length(gone)) / len(layout.sep) + 1


def csv_reader(reader, columns: Sequence[str], layout: Layout):
    """A batch or stream reader set up for the layout; cells are text."""
    encoding = {"UTF-8-SIG": "UTF-8"}.get(layout.encoding.upper(), layout.encoding)
    return (
        reader.schema(_schema(columns))
        .options(**_csv_options(layout))
        .option("header", layout.header)
        .option("encoding", encoding)
        .option("multiLine", layout.multiline or encoding.upper().startswith("UTF-16"))
        .option("recursiveFileLookup", True)
        # all fields are looked at whatever a query reads, or bad lines would go unseen
        .option("columnPruning", False)
    )


def apply_bad_line_policy(
    rows: DataFrame,
    columns: Sequence[str],
    layout: Layout,
    on_bad_lines: str = "warn",
    short_rows: str = "pad",
) -> DataFrame:
    """Keep, drop or stop at lines with too many fields; see :func:`scan_delimited`."""
    # the reader refuses a query that needs its raw line alone, so a cell is always needed too
    with_cell = F.length(F.concat(F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")), F.lit("|"))) > 0
    bad = F.col(_RAW).isNotNull() & with_cell
    if short_rows == "pad":
        # the reader reports short and long rows alike; only long ones are bad lines
        bad = bad & (fields_in(F.col(_RAW), layout) > len(columns))
    return bad_lines_apart(rows.withColumn(BAD_LINE, F.when(bad, F.col(_RAW))).drop(_RAW), on_bad_lines)


def bad_lines_apart(rows: DataFrame, on_bad_lines: str) -> DataFrame:
    """Rows with ``_bad_line`` (null for good ones), without the bad ones, or an error at the first."""
    if on_bad_lines == "warn":
        return rows
    if on_bad_lines == "skip":
        return rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    if on_bad_lines == "error":
        stop = F.raise_error(F.concat(F.lit("bad line: "), F.col(BAD_LINE)))
        kept = F.when(F.col(BAD_LINE).isNotNull(), stop.cast("boolean")).otherwise(F.lit(True))
        return rows.where(kept).drop(BAD_LINE)
    raise ValueError("on_bad_lines must be 'error', 'warn' or 'skip'")


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    layout: Layout = Layout(),
    on_bad_lines: str = "warn",
    short_rows: str = "pad",
    with_file: bool = False,
    with_position: bool = False,
) -> DataFrame:
    """The cells of a file set as text columns.

    ``on_bad_lines``: ``error`` stops the job, ``skip`` leaves bad lines out, ``warn`` keeps
    them with the raw line in ``_bad_line`` so that they can be counted and set aside. A row
    with too few fields is filled with NULLs, or bad when ``short_rows="bad"``.
    ``with_file`` adds the path, ``with_position`` the columns of ``FILE_ORDER``.
    """
    wide = layout.encoding.upper().startswith("UTF-16") and not layout.multiline
    by_line = layout.header and layout.header_row > 0 or not layout.skip_blank_lines
    if by_line or wide and opened_by_tasks(spark, path) is not None:
        rows = _scan_by_line(spark, path, columns, layout)
    else:
        rows = csv_reader(spark.read, columns, layout).csv(path)
        rows = rows.select(
            *rows.columns,
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_block_start").alias("_block_start"),
            *([F.monotonically_increasing_id().alias("_position")] if with_position else []),
        )
    if not with_position:
        rows = rows.drop(*FILE_ORDER[0 if not with_file else 1 :])
    return apply_bad_line_policy(rows, columns, layout, on_bad_lines, short_rows)


# The header positions are broadcast up to this size, else joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


def _after_header(lines: DataFrame, header_row: int) -> DataFrame:
    """Lines below the header line of their file; none of a file that does not reach it.

    ``lines`` is a staged table: positions are only compared within one reading of the files,
    because another reading may deal the files to tasks otherwise. The headers, one small row
    per file, are measured and broadcast within the limit, so the lines are not shuffled.
    """
    heads = file_heads(lines, header_row + 1).where(F.col("line_no") == header_row + 1)
    header = heads.select("file", F.col("pos").alias("_header_pos"))
    row_bytes = F.octet_length("file").cast("bigint") + 64
    size = header.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        header = F.broadcast(header)
    return lines.join(header, "file").where(
        (F.col("block_start") > 0) | (F.col("pos") > F.col("_header_pos"))
    )


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The numbered lines of a file set, written once to the shared folder."""
    lines = raw_lines(spark, path).withColumn("value", F.col("value").cast("binary"))
    place = staging_path(spark, "lines")
    lines.write.parquet(place)
    return spark.read.schema(lines.schema).parquet(place).withColumn("value", F.col("value").cast("string"))


def opened_by_tasks(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    """The files of ``path`` if tasks can open all of them; None leaves them to Spark's scans."""
    if not readable(path):
        return None
    files = list_files(spark, path)
    return None if has_unknown_codec(files) else files


def body_lines(spark: SparkSession, path: str | list[str], encoding: str, skip: int) -> DataFrame:
    """(file, block_start, pos, line): decoded lines below the first ``skip`` lines with text.

    Files are read range by range (:func:`sluicegate.sources.ranges.range_lines`). Where tasks
    cannot open them, Spark's scan numbers the lines, which are written down first to fix their
    numbers; it knows fewer encodings, and cuts UTF-16 wherever the byte of a line feed stands.
    """
    files = opened_by_tasks(spark, path)
    if files is not None:
        codec_of(encoding)
        return range_lines(files.select("file", "file_size", F.lit(encoding).alias("encoding"), F.lit(skip).alias("skip")))
    known = line_encoding(encoding)
    lines = _after_header(numbered_lines(spark, path), skip - 1) if skip else raw_lines(spark, path)
    return lines.select("file", "block_start", "pos", decode(F.col("value"), F.lit(known)).alias("line"))


def _scan_by_line(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], layout: Layout
) -> DataFrame:
    if layout.multiline:
        raise ValueError("multiline files cannot be read below a header row or with blank lines kept")
    lines = body_lines(spark, path, layout.encoding, layout.header_row + 1 if layout.header else 0)
    if layout.skip_blank_lines:
        lines = lines.where(F.trim("line") != "")
    return lines.select(
        _split("line", columns, layout),
        F.col("file").alias(SOURCE_FILE),
        F.col("block_start").alias("_block_start"),
        F.col("pos").alias("_position"),
    )


def header_names(
    spark: SparkSession, path: str | list[str], layout: Layout = Layout()
) -> DataFrame:
    """The names in the header line of every file: (file, column_names)."""
    from sluicegate.sources.dialect import split_line

    heads = head_lines(spark, path, layout.header_row + 1)
    line = decode(F.col("value"), F.lit(line_encoding(layout.encoding)))
    return heads.where(F.col("line_no") == layout.header_row + 1).select(
        "file", split_line(line, F.lit(layout.sep)).alias("column_names")
    )


def parse_lines(
    lines: DataFrame, column: str, columns: Sequence[str], layout: Layout = Layout(),
    on_bad_lines: str = "warn", short_rows: str = "pad",
) -> DataFrame:
    """Cells of delimited lines that are already in a column, under the same policies."""
    others = [c for c in lines.columns if c != column]
    rows = lines.select(_split(column, columns, layout), *others)
    return apply_bad_line_policy(rows, columns, layout, on_bad_lines, short_rows)


def sample_rows(df: DataFrame, order_by: Sequence[str], rows: int = 1000) -> DataFrame:
    """The first ``rows`` rows in the given order (a top-k sort, not a full one)."""
    return df.orderBy(*order_by).limit(rows)
