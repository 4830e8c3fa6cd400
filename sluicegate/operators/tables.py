"""Catalog tables: writing with an if-exists policy, surrogate ids, statistics."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicegate.workspace import keep_staged, remove_staged, staged, staging_path

_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def write_table(
    df: DataFrame, table: str, if_exists: str = "fail", path: str | None = None
) -> None:
    """Write to a catalog table.

    ``fail`` raises when the table exists and leaves it alone. ``append`` adds rows by column
    name; a column the table does not have raises, one that only the table has is NULL.
    ``replace`` writes a table beside the old one, puts the old one aside by name, gives the new
    one its name and only then drops the old one, so that whatever fails the old table is there,
    under its name or put back. A table that keeps its ``path`` is computed to a staging folder
    first and then copied over the old one; if the copy fails, the error says where the rows are.
    """
    if if_exists not in _MODES:
        raise ValueError("if_exists must be 'fail', 'replace' or 'append'")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if if_exists == "append" and exists:
        df = _in_table_order(df, spark.table(table))
    if if_exists == "replace" and exists:
        if path is not None and path.removeprefix("file:").rstrip("/") == _location(spark, table):
            _replace_in_place(df, table, path)
        else:
            _replace_beside(df, table, path)
        return
    _save(df, table, _MODES[if_exists], path)


def _save(df: DataFrame, table: str, mode: str, path: str | None) -> None:
    writer = df.write.format("parquet").mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _replace_beside(df: DataFrame, table: str, path: str | None) -> None:
    spark, mark = df.sparkSession, uuid.uuid4().hex
    new, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    try:
        _save(df, new, "errorifexists", path)
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {old}")


def _replace_in_place(df: DataFrame, table: str, path: str) -> None:
    """Compute and write everything elsewhere before the old files go."""
    spark = df.sparkSession
    place = staging_path(spark, "replace")
    try:
        df.write.parquet(place)
    except Exception:
        remove_staged(spark, place)
        raise
    try:
        _save(spark.read.schema(df.schema).parquet(place), table, "overwrite", path)
    except Exception as error:
        keep_staged(place)
        raise RuntimeError(f"the rows of {table} were not copied from {place}") from error
    remove_staged(spark, place)


def _in_table_order(df: DataFrame, old: DataFrame) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    extra = sorted(set(have) - {c.lower() for c in old.columns})
    if extra:
        raise ValueError(f"the table has no column {', '.join(have[c] for c in extra)}")
    return df.select(
        *[
            F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in old.schema
        ]
    )


def _location(spark: SparkSession, table: str) -> str:
    facts = json.loads(spark.sql(f"DESCRIBE EXTENDED {table} AS JSON").first()[0])
    return facts.get("location", "").removeprefix("file:").rstrip("/")


def has_column(df: DataFrame, name: str) -> bool:
    """Whether there is a column of that name, in upper or lower case."""
    return name.lower() in (c.lower() for c in df.columns)


def next_id(spark: SparkSession, table: str, id_column: str = "id") -> int:
    """The id after the largest one of a table; 1 when there is none."""
    if not spark.catalog.tableExists(table) or not has_column(spark.table(table), id_column):
        return 1
    return (spark.table(table).agg(F.max(id_column)).first()[0] or 0) + 1


def add_surrogate_id(
    df: DataFrame, order_by: Sequence[str], id_column: str = "id", start: int = 1
) -> DataFrame:
    """Number the rows ``start``, ``start``+1, ... in the given order, in parallel.

    Rows are range-partitioned by the order key (ties by row hash, then at random, so that a
    key or a row with very many copies is spread over partitions), sorted inside their
    partition and written to the shared folder with their places. A row's id is the number of
    rows in earlier partitions plus its place in its own. A column of that name, whatever its
    case, that is already there is left as it is.
    """
    if has_column(df, id_column):
        return df
    order = [F.col(f"`{c}`") for c in order_by]
    tie, spread = F.col("_tie"), F.col("_spread")
    placed = staged(
        df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        .withColumn("_spread", F.rand(17))
        .repartitionByRange(*order, tie, spread)
        .sortWithinPartitions(*order, tie, spread)
        .drop("_tie", "_spread")
        .withColumn("_mono", F.monotonically_increasing_id()),
        "numbered",
    )
    partition = F.shiftright("_mono", _POSITION_BITS)
    sizes = placed.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort: thousands at most, so the window over them
    # and the broadcast are bounded by the partition count, not by the data
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    place = F.col("_mono").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + place + F.lit(start)).alias(id_column), *[F.col(f"`{c}`") for c in df.columns])
    )


def table_stats_report(spark: SparkSession, database: str, with_total: bool = True) -> DataFrame:
    """Rows, bytes, megabytes and columns of every table of a database, and the total.

    Spark computes and keeps the statistics; only catalog entries are read here.
    """
    spark.sql(f"ANALYZE TABLES IN {database} COMPUTE STATISTICS")
    entries = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        described = spark.sql(f"DESCRIBE EXTENDED {database}.`{table.name}` AS JSON").first()[0]
        facts = json.loads(described)
        stats = facts.get("statistics", {})
        entries.append(
            (
                table.name,
                int(stats.get("num_rows", 0)),
                int(stats.get("size_in_bytes", 0)),
                len(facts["columns"]),
            )
        )
    report = spark.createDataFrame(
        entries, "table_name string, row_count bigint, size_bytes bigint, column_count bigint"
    )
    if with_total:
        total = report.agg(
            F.lit("(all tables)").alias("table_name"),
            F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("row_count"),
            F.coalesce(F.sum("size_bytes"), F.lit(0).cast("bigint")).alias("size_bytes"),
            F.coalesce(F.sum("column_count"), F.lit(0).cast("bigint")).alias("column_count"),
        )
        report = report.unionAll(total)
    return report.withColumn("size_mb", F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 2))
