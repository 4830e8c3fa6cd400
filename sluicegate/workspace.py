"""Where intermediate data goes: the shared folder named by the session."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Per thread, what was staged inside each open :func:`stages_removed`, the innermost last.
_open = threading.local()


def _stages() -> list[list[str]]:
    if not hasattr(_open, "stages"):
        _open.stages = []
    return _open.stages


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or the checkpoint folder set in code.

    Only a local-mode session with neither (a test) falls back to a fresh temporary folder;
    on a cluster that is an error, because a folder of one machine is not visible to the
    others.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluicegate-"))
    return spark.sparkContext.getCheckpointDir()


def staging_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/sluicegate/{label}-{uuid.uuid4().hex}"
    if _stages():
        _stages()[-1].append(path)
    return path


@contextmanager
def stages_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, also after an error, whatever is staged inside.

    For work whose result is written for good inside, and for callers that have collected what
    they need from a result that reads staged data.
    """
    made: list[str] = []
    _stages().append(made)
    try:
        yield
    finally:
        _open.stages = [other for other in _stages() if other is not made]
        for path in made:
            remove_staged(spark, path)


def keep_staged(path: str) -> None:
    """Leave a path out of what :func:`stages_removed` removes."""
    for made in _stages():
        if path in made:
            made.remove(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, so that what follows does not compute it anew."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for_small_work(spark: SparkSession) -> int:
    """Into how many tasks to deal work whose bytes tell nothing of its cost, such as many small files."""
    return 4 * spark.sparkContext.defaultParallelism


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Let a scan that is made inside list many folders by a few tasks per core, not by a task for each."""
    before = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, min(int(before), tasks_for_small_work(spark)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_TASKS, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_staged(spark: SparkSession, path: str) -> None:
    """Delete a path made by :func:`staging_path` when nothing reads it any more."""
    if "/sluicegate/" not in path:
        raise ValueError(f"{path} is not a staging path")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per context, as ``spark-submit --py-files`` would."""
    context = spark.sparkContext
    if not getattr(context, "_sluicegate_shipped", False):
        package = Path(__file__).resolve().parent
        made = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
        )
        context.addPyFile(made)
        context._sluicegate_shipped = True
