"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes all its predecessor kept and is written as Parquet before the
next one reads it. All but the last return the columns of `documents`, with
n_chars counted anew where the text changed. A missing table of documents is an
error; an empty one goes through all stages. Null texts fail the quality rules.
Documents without an id are never taken for copies. Columns beyond those of
`documents` are handed on untouched, whatever their names; one named like a
result of mixing comes out as `doc_<name>`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.llm import decontamination, mixing, quality, simhash, templates
from tillspark.llm.text import table
from tillspark.sources.staging import delete, shared_folder, staging_area

OWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def extras_aside(stage: Stage) -> Stage:
    """`stage` with columns that are not its own under names that no operator uses."""

    @wraps(stage)
    def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in OWN else f"extra_{at}" for at, c in enumerate(docs.columns)]
        before = dict(zip(names, docs.columns, strict=True))
        out = stage(spark, docs.toDF(*names), sf_dir)
        added = {c.lower() for c in out.columns if c not in before}
        final = [before.get(c, c) for c in out.columns]
        return out.toDF(
            *[
                f"doc_{name}" if c in before and name.lower() in added else name
                for c, name in zip(out.columns, final, strict=True)
            ]
        )

    return apart


@extras_aside
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the outlier test keep."""
    judged = quality.assess(docs, tuple(docs.columns))
    return judged.where("kept").select(*docs.columns)


@extras_aside
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates."""
    return _counted(templates.drop_templates(docs).select(*docs.columns))


@extras_aside
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash near-dedup links by its own settings: the one with
    the smallest doc_id."""
    return simhash.one_of_each(docs)


@extras_aside
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    clean = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _counted(clean)


@extras_aside
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with size, source_size, target and the words taken."""
    mixed = mixing.mix(docs, keep=tuple(docs.columns))
    return mixed.where("taken > 0")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]
ORACLE_SQL = None  # outliers, templates and fingerprints are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the last stage, read from where it wrote them. What a stage staged, and
    what the stage before wrote, is deleted when it is done."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        with staging_area(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            delete(spark, f"{folder}/{number - 1}")
    return docs
