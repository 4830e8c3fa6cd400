"""Written intermediate tables in the shared folder, and Python steps over Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sluicegate.workspace import remove_staged, staging_path


#: Spark's own switch: shuffle files go when the execution that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    What follows reads the table instead of computing it anew, and a lost executor loses
    nothing of it. The shuffles behind the table are not needed any more once it is written, so
    they go at once.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        remove_staged(table.sparkSession, table.staged_path)


def file_system(path: str):
    """The Arrow file system of a folder and its path there, for raw files of the shared folder."""
    from pyarrow import fs

    if path.startswith("s3a://"):
        path = path.replace("s3a://", "s3://", 1)
    elif path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, as a number to size groups by."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_map(df: DataFrame, step, schema: str) -> DataFrame:
    """``df.mapInArrow``, with this package at hand in the Python workers."""
    ship(df.sparkSession)
    return df.mapInArrow(step, schema)


def arrow_groups(df: DataFrame, keys: list[str], step, schema: str) -> DataFrame:
    """``df.groupBy(keys).applyInArrow``, with this package at hand in the Python workers."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(step, schema)


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per context, as ``spark-submit --py-files`` would."""
    context = spark.sparkContext
    if not getattr(context, "_sluicegate_shipped", False):
        package = Path(__file__).resolve().parents[1]
        made = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
        )
        context.addPyFile(made)
        context._sluicegate_shipped = True
