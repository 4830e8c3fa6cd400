"""Incremental loading of a folder into a catalog table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicegate.operators.cast import TYPED, classify, good_rows, quarantine_rows
from sluicegate.operators.infer import SPARK_TYPES
from sluicegate.operators.tables import add_surrogate_id
from sluicegate.plans.analyze import detect_layout
from sluicegate.plans.load import infer_types, stage_rows
from sluicegate.sources.delimited import FILE_ORDER, Layout, scan_delimited
from sluicegate.streaming.ingest import placed_stream
from sluicegate.workspace import path_exists, stages_removed, staging_path

#: The partition column of the table: the number of the batch that loaded a row.
BATCH = "load_batch"


def _plan(spark: SparkSession, place: str, make) -> dict:
    """What ``make`` decided on the first run, kept beside the stream's checkpoint."""
    if not path_exists(spark, f"{place}/_SUCCESS"):
        text = json.dumps(make())
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(place)
    return json.loads(spark.read.text(place).first().value)


def _decide(spark, path, columns, layout, types, overrides, day_first) -> dict:
    if layout is None or columns is None:
        found, names = detect_layout(spark, path)
        layout, columns = layout or found, columns or names
    orders: dict[str, bool] = {}
    if types is None:
        types, orders = infer_types(scan_delimited(spark, path, columns, layout), columns, overrides)
    return {
        "layout": asdict(layout),
        "columns": list(columns),
        "types": {c: SPARK_TYPES.get(types[c].upper(), types[c]) for c in columns},
        "day_first": orders | dict(day_first or {}),
    }


def _create(spark: SparkSession, table: str, fields: list[str]) -> None:
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({', '.join(fields)}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH})")
    elif BATCH not in spark.table(table).columns:
        raise ValueError(f"{table} was not loaded in batches")


def load_incremental(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    columns: Sequence[str] | None = None,
    layout: Layout | None = None,
    types: Mapping[str, str] | None = None,
    overrides: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
    id_column: str | None = None,
    files_per_batch: int = 1000,
    quarantine_path: str | None = None,
    day_first: Mapping[str, bool] | None = None,
    on_bad_lines: str = "warn",
) -> StreamingQuery:
    """Load the files of ``path`` that were not loaded before into ``table``, then stop.

    Layout, columns and types are detected on the first run, over all files that are there, and
    kept in the checkpoint, so later files are read alike. Every batch writes its own partition
    of the table (column ``load_batch``) and replaces it when the batch is run again, so a run
    that dies is resumed without losing or repeating rows. With ``id_column`` rows are numbered
    from 1 without gaps, batch after batch, in the order of the lines in the files: a batch
    begins after the rows of the batches before it, whose numbers are kept in the checkpoint.
    Bad rows go to ``quarantine_path``, one folder per batch. An id column that the files already
    have, whatever its case, loads as it is.
    """
    with stages_removed(spark):
        plan = _plan(
            spark, f"{checkpoint}/plan", lambda: _decide(spark, path, columns, layout, types, overrides, day_first)
        )
    layout, columns, types = Layout(**plan["layout"]), plan["columns"], plan["types"]
    if id_column is not None and id_column.lower() in (c.lower() for c in columns):
        id_column = None
    fields = [f"`{c}` {'STRING' if t.lower() == 'time' else t}" for c, t in types.items()]
    _create(spark, table, [f"`{id_column}` BIGINT", *fields] if id_column else fields)
    counts = f"{checkpoint}/rows"

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with stages_removed(session):
            rows = batch.withColumn("_position", F.monotonically_increasing_id())
            classified = classify(rows, types, required, plan["day_first"])
            fixed = stage_rows(classified, columns, FILE_ORDER, staging_path(session, "batch"))
            good = good_rows(fixed.where("_is_bad = 0"), columns, keep=FILE_ORDER)
            if id_column:
                good = add_surrogate_id(good, FILE_ORDER, id_column, 1 + rows_before(session, counts, number))
                good = good.select(id_column, *[F.col(f"`{c}`") for c in columns])
            else:
                good = good.drop(*FILE_ORDER)
            good.createOrReplaceTempView("_loading")
            session.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = {number}) SELECT * FROM _loading")
            session.catalog.dropTempView("_loading")
            if quarantine_path is not None:
                bad = quarantine_rows(fixed.where("_is_bad = 1"), columns)
                bad.write.mode("overwrite").json(f"{quarantine_path}/{BATCH}={number}")
            loaded = fixed.where("_is_bad = 0").agg(F.count(F.lit(1)).alias("rows"))
            loaded.write.mode("overwrite").parquet(f"{counts}/batch={number}")

    return (
        placed_stream(spark, path, columns, layout, files_per_batch, on_bad_lines)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )


def rows_before(spark: SparkSession, counts: str, number: int) -> int:
    """Rows that the batches before ``number`` loaded."""
    if not path_exists(spark, counts):
        return 0
    kept = spark.read.schema("rows bigint, batch bigint").parquet(counts)
    return kept.where(F.col("batch") < number).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
