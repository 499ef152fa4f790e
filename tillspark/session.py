"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Adaptive execution on, UTC, no UI.

    On a cluster leave `shuffle_partitions` unset and start high: adaptive
    execution merges small partitions but cannot split a whole stage's worth of
    data that was hashed into too few of them.
    """
    builder = (
        SparkSession.builder.appName("tillspark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
