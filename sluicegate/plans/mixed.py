"""Reading a folder whose files are written in different ways as one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.names import UNNAMED, sanitize_name
from sluicegate.operators.cast import BAD_LINE, SOURCE_FILE
from sluicegate.sources.delimited import FILE_ORDER, Layout, bad_lines_apart, fields_in, numbered_lines, split_cells
from sluicegate.sources.dialect import dialect_report, split_line
from sluicegate.sources.heads import first_lines
from sluicegate.sources.lines import decode, file_heads
from sluicegate.sources.ranges import has_unknown_codec, range_lines, readable
from sluicegate.workspace import staged


def _told_apart(names: Column) -> Column:
    """Names of one file with a number after the second of its kind, whatever its case."""

    def numbered(name: Column, i: Column) -> Column:
        earlier = F.filter(F.slice(names, F.lit(1), i), lambda other: F.lower(other) == F.lower(name))
        return F.when(F.size(earlier) == 0, name).otherwise(F.concat(name, F.lit("_"), F.size(earlier) + 1))

    return F.transform(names, numbered)


def file_layouts(spark: SparkSession, path: str | list[str], headerless: Sequence[str] = ()) -> DataFrame:
    """(file, file_size, encoding, delimiter, has_header, names), a staged table.

    A file whose first line is the header of another file has that header, though it holds
    nothing else. A file without header gets the names ``headerless`` if it has that many
    columns, else positional ones. Names are made safe for a table and differ inside a file.
    Files without a line of text are left out.
    """
    dialects = staged(dialect_report(spark, path), "dialects")
    heads = first_lines(spark, path, 1, dialects).where(F.size("heads") > 0)
    line = decode(F.get("heads", F.lit(0)).cast("string"), F.col("encoding"))
    first = staged(
        heads.withColumn("first", split_line(line, F.col("delimiter"))).drop("heads", "column_names"), "first-lines"
    )
    # a few rows: one per distinct header
    headers = first.where("has_header").select(F.col("first").alias("known")).distinct()
    known = first.join(headers, F.col("first") == F.col("known"), "left")
    has_header = F.col("has_header") | F.col("known").isNotNull()
    given = F.array(*[F.lit(c) for c in headerless]).cast("array<string>")
    positional = F.when(F.size("first") == len(headerless), given).otherwise(
        F.transform("first", lambda _, i: F.concat(F.lit("column_"), (i + 1).cast("string")))
    )
    names = F.transform("first", lambda c: sanitize_name(F.trim(c)))
    named = F.when(has_header, F.transform(names, lambda n: F.when(n == "", UNNAMED).otherwise(n))).otherwise(positional)
    rows = known.select(
        "file", "file_size", "encoding", "delimiter", has_header.alias("has_header"), named.alias("given")
    )
    return staged(rows.withColumn("names", _told_apart(F.col("given"))).drop("given"), "layouts")


def layouts_of(files: DataFrame) -> tuple[list[str], DataFrame]:
    """All columns of the files, by their first place in any, and the distinct layouts.

    The second is a staged table of layout (a number), delimiter, names, and places: where a file
    of that layout has each of the columns, -1 where it has not.
    """
    distinct = files.select("delimiter", "names").distinct()
    layouts = staged(distinct.withColumn("layout", F.monotonically_increasing_id()), "layouts-told-apart")
    placed = layouts.select(F.posexplode("names").alias("place", "name"))
    columns = [
        r.name
        for r in placed.groupBy(F.lower("name").alias("key"))
        .agg(F.min_by("name", F.struct("place", "name")).alias("name"), F.min("place").alias("place"))
        .orderBy("place", "key")
        .select("name")
        .collect()  # the columns of the result
    ]
    lowered = F.transform("names", lambda n: F.lower(n))
    places = F.array(*[F.array_position(lowered, c.lower()).cast("int") - 1 for c in columns])
    return columns, layouts.withColumn("places", places)


def _lines(spark: SparkSession, path: str | list[str], files: DataFrame) -> DataFrame:
    """(file, block_start, pos, line, layout) of the files, without their headers."""
    if readable(path) and not has_unknown_codec(files):
        return range_lines(files.withColumn("skip", F.col("has_header").cast("int")), "layout")
    lines = numbered_lines(spark, path)  # Spark's scan; its numbers hold for one reading
    head = file_heads(lines, 1).select("file", F.col("pos").alias("_first"))
    known = files.select("file", "encoding", "has_header", "layout").join(head, "file")
    body = lines.join(known, "file").where(
        ~F.col("has_header") | (F.col("block_start") > 0) | (F.col("pos") > F.col("_first"))
    )
    text = decode(F.col("value"), F.col("encoding"))
    return body.select("file", "block_start", "pos", text.alias("line"), "layout")


def scan_mixed(
    spark: SparkSession, path: str | list[str], headerless: Sequence[str] = (), on_bad_lines: str = "warn"
) -> DataFrame:
    """The cells of all files as text columns, matched by name; columns a file lacks are NULL.

    Files are read once, line by line, each in its own encoding, so quoted line breaks are not
    allowed. A line is split by the separator of its file, and its layout tells where the columns
    stand, so one plan reads any number of layouts. Files without a line of text have no rows and
    no say. ``FILE_ORDER`` and, unless bad lines are skipped, ``_bad_line`` come along as in
    :func:`sluicegate.sources.delimited.scan_delimited`.
    """
    files = file_layouts(spark, path, headerless)
    columns, layouts = layouts_of(files)
    widths = layouts.groupBy("delimiter").agg(F.max(F.size("names")).alias("width")).collect()
    if not widths:
        raise ValueError("no files with text")
    known = files.join(layouts.select("layout", "delimiter", "names"), ["delimiter", "names"])
    lines = _lines(spark, path, known).where(F.trim("line") != "")
    rows = lines.join(layouts.select("layout", "delimiter", F.size("names").alias("width"), "places"), "layout")
    cells, fields = F.lit(None).cast("array<string>"), F.lit(0)
    for found in widths:  # one for each separator there is, of which a line uses its own
        layout, own = Layout(sep=found.delimiter), F.col("delimiter") == found.delimiter
        cells = F.when(own, split_cells(F.col("line"), found.width, layout)).otherwise(cells)
        fields = F.when(own, fields_in(F.col("line"), layout)).otherwise(fields)
    bad = F.when(fields > F.col("width"), F.col("line"))
    # a generator of one row, so that a later filter does not split the line again
    parsed = rows.select("*", F.inline(F.array(F.struct(cells.alias("cells"), bad.alias(BAD_LINE)))))

    def cell(i: int) -> Column:
        place = F.get("places", F.lit(i))
        return F.when((place >= 0) & (place < F.size("cells")), F.get("cells", place))

    table = parsed.select(
        *[cell(i).alias(c) for i, c in enumerate(columns)],
        F.col("file").alias(SOURCE_FILE),
        F.col("block_start").alias("_block_start"),
        F.col("pos").alias("_position"),
        BAD_LINE,
    )
    return bad_lines_apart(table, on_bad_lines)


def data_columns(rows: DataFrame) -> list[str]:
    """The columns of a mixed scan that come from the files."""
    return [c for c in rows.columns if c not in (*FILE_ORDER, BAD_LINE)]
