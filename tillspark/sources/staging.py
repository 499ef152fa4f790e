"""Intermediate tables written to the shared checkpoint folder.

A staged table cuts lineage the way a checkpoint does and outlives a lost
executor. Reading it back as Parquet also gives the planner its true size and
lets later steps read only the columns they use.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Temporary folders of local sessions that name none, by application.
_own: dict[str, str] = {}
# Rows of the tables staged here, by the name of their folder.
_rows: dict[str, int] = {}
_area: ContextVar[str | None] = ContextVar("staging_area", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only on a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tillspark-")
    return _own[app]


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; what is made of them must be written by then."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex}"
    before = _area.get()
    token = _area.set(folder)
    try:
        yield
    finally:
        _area.reset(token)
        if before is None:
            delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the staged tables `df` is read from, which nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1] in _rows:
            delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It deletes those nothing can reach any more, which it learns when the driver collects its
    garbage; between jobs that each shuffle much, that may be too late for the disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write `df` once and return it as read back."""
    return stage_observed(df, name, codec, rows=F.count(F.lit(1)))[0]


def stage_observed(
    df: DataFrame, name: str, codec: str | None = None, **totals: Column
) -> tuple[DataFrame, dict[str, Any]]:
    """`stage`, and totals over the rows, taken while they are written."""
    seen = Observation()
    totals.setdefault("rows", F.count(F.lit(1)))
    measured = df.observe(seen, *[total.alias(alias) for alias, total in totals.items()])
    staged, folder = _write(measured, df, name, codec)
    _rows[folder] = seen.get["rows"]
    return staged, seen.get


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`stage`, and the row count."""
    staged, seen = stage_observed(df, name, rows=F.count(F.lit(1)))
    return staged, seen["rows"]


def written_rows(df: DataFrame) -> int | None:
    """Rows of the staged table that `df`, which must not multiply rows, is read from.

    None if it reads something else, or several tables. Rows added by a union with
    constants are not counted. Runs no job.
    """
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    if len(folders) != 1:
        return None
    return _rows.get(folders.pop().rsplit("/", 1)[-1])


def side_by_side(spark: SparkSession, **steps: Callable[[], Any]) -> dict[str, Any]:
    """The results of steps that do not depend on each other, their jobs run together."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        started = {
            name: pool.submit(copy_context().run, inheritable_thread_target(spark)(step))
            for name, step in steps.items()
        }
        return {name: done.result() for name, done in started.items()}


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage tables that do not depend on each other side by side."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    steps = {name: partial(stage, df, name) for name, df in frames.items()}
    return side_by_side(spark, **steps)


def _write(
    observed: DataFrame, df: DataFrame, name: str, codec: str | None = None
) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    folder = _area.get() or f"{shared_folder(spark)}/{app}"
    own = f"{name}-{uuid.uuid4().hex}"
    observed.write.parquet(f"{folder}/{own}", compression=codec)
    return spark.read.schema(df.schema).parquet(f"{folder}/{own}"), own
