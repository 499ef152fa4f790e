"""Run-versioned Parquet tables behind one manifest.

A run writes every table under a fresh `runs/<run_id>/` folder, reads them back
to check them, and only then replaces the manifest. Readers go through the
manifest, so they see one run's tables or another's, never a mixture.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "CURRENT.json"
# Fixed value: what a run id may look like, as it becomes a folder name.
RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._~:+=-]{0,199}")


class PublishError(RuntimeError):
    """A version is incomplete or unreadable and must not become visible."""


def _files(spark: SparkSession, root: str) -> tuple[Any, Any]:
    """The Hadoop file system behind `root`, and its path constructor."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _read_text(fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    """What is published under `root`, or None when nothing is."""
    fs, path = _files(spark, root)
    current = path(f"{root}/{MANIFEST}")
    if not fs.exists(current):
        return None
    return json.loads(_read_text(fs, current))


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    manifest = read_manifest(spark, root)
    if manifest is None:
        raise PublishError(f"nothing is published under {root}")
    if table not in manifest["tables"]:
        raise PublishError(f"{table} is not among the published tables of {root}")
    version = manifest["version"]
    if not RUN_ID.fullmatch(version):
        raise PublishError(f"the manifest names an unusable version {version!r}")
    return spark.read.parquet(f"{root}/runs/{version}/{table}")


def _new_version(fs, path, root: str, run_id: str) -> str:
    """A folder for this attempt only: a retried run never reuses one."""
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id {run_id!r} cannot name a folder")
    attempt, name = 1, run_id
    while fs.exists(path(f"{root}/runs/{name}")):
        attempt += 1
        name = f"{run_id}__{attempt}"
    fs.mkdirs(path(f"{root}/runs/{name}"))
    return name


def verify_version(
    spark: SparkSession, root: str, version: str, tables: dict[str, int]
) -> None:
    """Raise unless every table is complete, readable and holds the rows written."""
    fs, path = _files(spark, root)
    for name, rows in tables.items():
        folder = f"{root}/runs/{version}/{name}"
        if not fs.exists(path(f"{folder}/_SUCCESS")):
            raise PublishError(f"{folder} is missing or was not written to the end")
        try:
            found = spark.read.parquet(folder).count()
        except Exception as error:
            raise PublishError(f"{folder} cannot be read: {error}") from error
        if found != rows:
            raise PublishError(f"{folder} holds {found} rows, {rows} were written")


def retired_tables(before: dict | None, tables: set[str]) -> list[str]:
    """Tables the previous version published and this one does not."""
    return sorted(set(before["tables"]) - tables) if before else []


def publish(
    spark: SparkSession,
    root: str,
    run_id: str,
    tables: dict[str, DataFrame],
    metrics: dict | None = None,
) -> dict:
    """Write, verify and make visible; returns the new manifest."""
    fs, path = _files(spark, root)
    before = read_manifest(spark, root)
    version = _new_version(fs, path, root, run_id)
    rows = {name: _write_counted(df, f"{root}/runs/{version}/{name}") for name, df in tables.items()}
    verify_version(spark, root, version, rows)
    manifest = {
        "run_id": run_id,
        "version": version,
        "tables": rows,
        "retired": retired_tables(before, set(tables)),
        "metrics": metrics or {},
    }
    _replace(spark, fs, path, root, json.dumps(manifest, indent=2, default=str))
    return manifest


def _write_counted(df: DataFrame, folder: str) -> int:
    """Write a table and return how many rows passed on their way to it."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(folder)
    return seen.get["rows"]


def _replace(spark: SparkSession, fs, path, root: str, text: str) -> None:
    """Put the manifest in place with one rename over the old one."""
    fresh, current = path(f"{root}/{MANIFEST}.new"), path(f"{root}/{MANIFEST}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 1
    )
    options[0] = overwrite
    context.rename(fresh, current, options)


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """Every table as CSV with a header, dates as yyyy-MM-dd."""
    for name, df in tables.items():
        (
            df.write.mode("errorifexists")
            .option("header", True)
            .option("dateFormat", "yyyy-MM-dd")
            .option("timestampNTZFormat", "yyyy-MM-dd")
            .csv(f"{folder}/{name}")
        )
