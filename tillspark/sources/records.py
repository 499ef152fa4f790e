"""CSV records as text columns, those that cannot be read kept apart.

A record cannot be read if it has more or fewer fields than the header, or a quote that does
not end. One such record must not stop a night's run, nor go missing: it is kept as it stands,
with its file and place, and counted. Files of another header are still an error, as all their
records would be misread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.sources.staging import stage, written_rows

# Position of a record in its feed; any column or struct that orders records will do.
SOURCE_POSITION = "src_pos"
CORRUPT = "_corrupt_record"


class FeedContractError(ValueError):
    """The feed does not look the way the settings say it does."""


def scan(spark: SparkSession, path: str, multi_line: bool = False, keep: bool = False) -> DataFrame:
    """The fields of every record as text, and its position.

    Quotes inside quoted fields are doubled. Records that cannot be read stop the scan with an
    error that names the file; with `keep` they are rows of nulls whose text is in CORRUPT.
    """
    feed = spark.read.options(
        header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False,
        columnPruning=False, mode="PERMISSIVE" if keep else "FAILFAST",
        columnNameOfCorruptRecord=CORRUPT,
    )
    names = [*feed.csv(path).columns, *([CORRUPT] if keep else [])]
    raw = feed.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)
    return raw.withColumn(
        SOURCE_POSITION,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def split_records(scanned: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Records that can be read, and the others as (feed, file, block, row, record).

    The scan is written once, so both sides come from one reading of the files.
    """
    held = stage(scanned, f"{feed}_records")
    bad = held.where(F.col(CORRUPT).isNotNull())
    rejects = bad.select(
        F.lit(feed).alias("feed"), f"{SOURCE_POSITION}.*", F.col(CORRUPT).alias("record")
    )
    return held.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rejects


def rejected_counts(rejects: DataFrame) -> DataFrame:
    """Records that could not be read, by feed and file."""
    return rejects.groupBy("feed", "file").agg(F.count(F.lit(1)).alias("records"))


def check_rejects(rejects: DataFrame, max_rate: float) -> dict[str, int]:
    """Rejected records by file; raises, naming the worst files, when they are too many.

    `max_rate` is the share of each feed's records, read or not, that may be rejected.
    """
    counts = [r.asDict() for r in rejected_counts(rejects).collect()]
    records = written_rows(rejects) or 0
    share = sum(c["records"] for c in counts) / records if records else 0.0
    if share > max_rate:
        worst = sorted(counts, key=lambda c: (-c["records"], c["file"]))[:5]
        listed = ", ".join(f"{c['file']} ({c['records']})" for c in worst)
        raise FeedContractError(f"{share:.2%} of the records cannot be read: {listed}")
    return {c["file"]: c["records"] for c in counts}
