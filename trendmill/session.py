"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Everything else (memory, parallelism) belongs to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_run: ContextVar[str | None] = ContextVar("run", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then uses its warehouse folder.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses, below the folder of the run around it."""
    return f"{_run.get() or f'{scratch_root(spark)}/trendmill'}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes values that depend on the execution, such as partition ids.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, by the file system it is on."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    if not exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return sorted(status.getPath().getName() for status in listed)


def discard(staged: DataFrame) -> None:
    """Delete what ``stage`` stored; neither the frame nor what was built on it may be used after that."""
    for path in {os.path.dirname(name) for name in staged.inputFiles()}:
        remove(staged.sparkSession, path)


T = TypeVar("T")


def side_by_side(jobs: list[Callable[[], T]]) -> Iterator[T]:
    """What the jobs return, in their order. They run at one time, so the last tasks of one leave no core idle.

    The first failure in that order is raised when all have ended. For a few writes to different places.
    """
    if not jobs:
        return
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(copy_context().run, job) for job in jobs]
        for future in started:
            yield future.result()


@contextmanager
def discarding_staged(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is staged inside, deleted on leaving. Frames that read it must not be used after that."""
    path = scratch_path(spark, "run")
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        remove(spark, path)
