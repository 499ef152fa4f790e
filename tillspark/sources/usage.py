"""The usage-event feed and the checks it must pass before being measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.functions.dates import NTZ
from tillspark.settings import NA_TOKENS, Adoption
from tillspark.sources.records import scan, split_records
from tillspark.sources.transactions import number

EVENT_SCHEMA = (
    "event_ts timestamp_ntz, user_id string, team string, event_type string, "
    "stock_code string, feedback_score double"
)
# Columns the adoption metrics read; stock_code is not one of them.
METRIC_COLUMNS = ("event_ts", "user_id", "team", "event_type", "feedback_score")


class UsageContractError(ValueError):
    """An event would enter a metric with a value the metric cannot mean."""


# The columns an event feed must have, by header name.
FEED_COLUMNS = ("event_ts", "user_id", "team", "event_type", "stock_code", "feedback_score")


def type_events(raw: DataFrame) -> DataFrame:
    """Type a frame of text columns; what cannot be read becomes null."""
    said = raw.select(
        *[F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)).alias(c) for c in FEED_COLUMNS]
    )
    return said.withColumns(
        {
            "event_ts": F.col("event_ts").try_cast(NTZ),
            "feedback_score": number(F.col("feedback_score")),
        }
    )


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Scan the event CSV by header name."""
    return type_events(spark.read.options(header=True, quote='"', escape='"').csv(path))


def read_usage_kept(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events, and the records that cannot be read."""
    good, rejects = split_records(scan(spark, path, keep=True), "usage")
    return type_events(good), rejects


def event_violations(events: DataFrame, settings: Adoption = Adoption()) -> DataFrame:
    """The events that break a rule, with the rule's name."""
    low, high = settings.csat_scale
    score = F.col("feedback_score")
    off_scale = (F.col("event_type") == "feedback") & ((score < low) | (score > high))
    no_team = F.col("team").isNull() | (F.trim("team") == "")
    broken = F.filter(
        F.array(
            F.when(off_scale, F.lit("score_off_scale")),
            F.when(no_team, F.lit("no_team")),
            F.when(F.col("event_ts").isNull(), F.lit("no_time")),
        ),
        lambda name: name.isNotNull(),
    )
    return events.withColumn("violation", F.explode(broken))


def check_events(events: DataFrame, settings: Adoption = Adoption()) -> None:
    """Raise on off-scale scores, listing five at most, and on events without a team or time."""
    bad = event_violations(events, settings)
    counts = {r["violation"]: r["count"] for r in bad.groupBy("violation").count().collect()}
    low, high = settings.csat_scale
    if counts.get("score_off_scale"):
        scores = (
            bad.where(F.col("violation") == "score_off_scale")
            .select("feedback_score").distinct().orderBy("feedback_score").limit(5).collect()
        )
        listed = ", ".join(f"{r[0]:g}" for r in scores)
        raise UsageContractError(
            f"{counts['score_off_scale']} feedback score(s) outside {low}-{high}: {listed}"
        )
    if counts.get("no_team"):
        raise UsageContractError(f"{counts['no_team']} event(s) have no team")
    if counts.get("no_time"):
        raise UsageContractError(f"{counts['no_time']} event(s) have no readable time")
