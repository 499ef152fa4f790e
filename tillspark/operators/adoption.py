"""Who uses the product: reach, activation, action rate and satisfaction.

The event log is read once and folded to one row per team, user and week. Every
table is made from those rows, under one analysis date and one headcount, so
each distinct count is a count of folded rows and no distinct set is held in a
task.
"""

from __future__ import annotations

import warnings
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.functions.dates import NTZ, calendar, week_start
from tillspark.functions.numbers import half_even, percent
from tillspark.functions.rows import literal_rows
from tillspark.settings import Adoption
from tillspark.sources.staging import stage


class UnpinnedAnalysisWarning(UserWarning):
    """No analysis date is configured."""


_TALLIES = ("views", "applies", "score_sum", "scores")


def as_of(events: DataFrame, settings: Adoption = Adoption()) -> Column:
    """The moment every window is measured back from, as a one-value column.

    A configured day means its last microsecond; without one, the newest event, with a
    warning: events that arrive later then change what an earlier report said.
    """
    if settings.analysis_as_of:
        moment = datetime.fromisoformat(str(settings.analysis_as_of))
        if moment == datetime(moment.year, moment.month, moment.day):
            moment += timedelta(days=1) - timedelta(microseconds=1)
        return F.lit(moment.isoformat(sep=" ")).cast(NTZ)
    warnings.warn(
        "analysis_as_of is not set: windows end at the newest event, and a rerun may differ",
        UnpinnedAnalysisWarning,
        stacklevel=2,
    )
    return events.agg(F.max("event_ts").alias("as_of")).scalar()


def as_of_frame(events: DataFrame, settings: Adoption = Adoption()) -> DataFrame:
    newest = events.agg(F.max("event_ts").alias("as_of"))
    if settings.analysis_as_of:
        return newest.select(as_of(events, settings).alias("as_of"))
    return newest


def usage_facts(events: DataFrame, settings: Adoption = Adoption()) -> DataFrame:
    """Events up to the analysis date, one row per team, user and Monday week.

    Later events belong to a later report. `recent` tells whether any event
    falls in the window that ends on the analysis date.
    """
    end = as_of(events, settings)
    start = end - F.expr(f"interval {7 * settings.active_window_weeks} days")
    kind, score = F.col("event_type"), F.col("feedback_score")
    given = (kind == "feedback") & score.isNotNull()
    return stage(
        events.where(F.col("event_ts") <= end)
        .groupBy("team", "user_id", week_start(F.col("event_ts")).alias("week_start"))
        .agg(
            F.max(F.col("event_ts") >= start).alias("recent"),
            F.count_if(kind == "view").alias("views"),
            F.count_if(kind == "apply").alias("applies"),
            F.sum(F.when(given, score).otherwise(F.lit(0))).alias("score_sum"),
            F.count_if(given).alias("scores"),
        ),
        "usage_facts",
    )


def _per_user(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.groupBy(*keys, "user_id").agg(
        F.max("recent").alias("recent"), *[F.sum(c).alias(c) for c in _TALLIES]
    )


def _totals(per_user: DataFrame, *keys: str) -> DataFrame:
    named = F.col("user_id").isNotNull()
    return per_user.groupBy(*keys).agg(
        F.count("user_id").alias("users"),
        F.count_if(named & F.col("recent")).alias("recent_users"),
        F.count_if(named & (F.col("applies") > 0)).alias("acted_users"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TALLIES],
    )


def _action_rate() -> Column:
    return percent(F.col("applies"), F.col("views"))


def _csat() -> Column:
    return half_even(F.try_divide("score_sum", "scores"), 2)


def _roster(facts: DataFrame, settings: Adoption) -> DataFrame:
    listed = literal_rows(
        facts.sparkSession,
        [(team, size, at) for at, (team, size) in enumerate(settings.roster.items())],
        "team string, licensed_users long, position long",
    )
    seen = facts.where(
        F.col("team").isNotNull() & ~F.col("team").isin(*settings.roster)
    )
    unlisted = (
        seen.groupBy("team", "user_id")
        .agg(F.count(F.lit(1)).alias("_weeks"))
        .groupBy("team")
        .agg(F.count("user_id").alias("licensed_users"))
        .withColumn("position", F.lit(len(settings.roster)).cast("long"))
    )
    return listed.unionByName(unlisted)


def effective_roster(
    events: DataFrame, settings: Adoption = Adoption(), facts: DataFrame | None = None
) -> DataFrame:
    """The licensed teams, plus active teams nobody licensed at their observed size.

    `position` keeps the configured order, unlisted teams following it.
    """
    return _roster(usage_facts(events, settings) if facts is None else facts, settings)


def _licensed(facts: DataFrame, settings: Adoption) -> Column:
    return _roster(facts, settings).agg(F.sum("licensed_users").alias("n")).scalar()


def adoption_headline(
    events: DataFrame, settings: Adoption = Adoption(), facts: DataFrame | None = None
) -> DataFrame:
    facts = usage_facts(events, settings) if facts is None else facts
    totals = _totals(_per_user(facts)).withColumn("licensed", _licensed(facts, settings))
    # Metrics in report order, each with its target.
    metrics = [
        ("reach_pct", percent(F.col("recent_users"), F.col("licensed")), settings.target_reach_pct),
        ("activation_pct", percent(F.col("acted_users"), F.col("licensed")), None),
        ("action_rate_pct", _action_rate(), settings.target_action_rate_pct),
        ("csat", _csat(), settings.target_csat),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            value.alias("value"),
            F.lit(target).cast("double").alias("target"),
        )
        for name, value, target in metrics
    ]
    status = (
        F.when(F.col("target").isNull(), "no target")
        .when(F.col("value").isNull(), "no data")
        .when(F.col("value") >= F.col("target"), "on track")
        .otherwise("below target")
    )
    return totals.select(F.inline(F.array(*rows))).withColumn("status", status)


def adoption_weekly(
    events: DataFrame, settings: Adoption = Adoption(), facts: DataFrame | None = None
) -> DataFrame:
    """One row per Monday week from the first to the last, idle weeks included."""
    facts = usage_facts(events, settings) if facts is None else facts
    in_week = _totals(_per_user(facts, "week_start"), "week_start")
    bounds = facts.agg(F.min("week_start").alias("first"), F.max("week_start").alias("last"))
    weeks = calendar(bounds, "week_start", "interval 7 days")
    zero = lambda name, out=None: F.coalesce(name, F.lit(0)).alias(out or name)
    trend = weeks.join(in_week, "week_start", "left").select(
        "week_start", zero("users", "active_users"), zero("views"), zero("applies")
    )
    return trend.select(
        # The calendar has one row per week, so one ordered pass numbers it.
        F.row_number().over(W.orderBy("week_start")).alias("week_no"),
        "week_start",
        "active_users",
        "views",
        "applies",
        percent(F.col("active_users"), _licensed(facts, settings)).alias("reach_pct"),
        _action_rate().alias("action_rate_pct"),
    )


def adoption_by_team(
    events: DataFrame, settings: Adoption = Adoption(), facts: DataFrame | None = None
) -> DataFrame:
    """One row per team on the effective roster, idle teams included, by reach."""
    facts = usage_facts(events, settings) if facts is None else facts
    used = _totals(_per_user(facts, "team"), "team")
    zero = lambda name: F.coalesce(name, F.lit(0))
    headcount = F.col("licensed_users")
    return (
        _roster(facts, settings)
        .join(used, "team", "left")
        .select(
            "team",
            "licensed_users",
            zero("recent_users").alias("active_users"),
            percent(zero("recent_users"), headcount).alias("reach_pct"),
            percent(zero("acted_users"), headcount).alias("activation_pct"),
            zero("views").alias("views"),
            zero("applies").alias("applies"),
            _action_rate().alias("action_rate_pct"),
            _csat().alias("csat"),
            zero("scores").alias("csat_responses"),
            "position",
        )
        .orderBy(F.col("reach_pct").desc(), "position", "team")
        .drop("position")
    )


def reach_change(events: DataFrame, settings: Adoption = Adoption()) -> DataFrame:
    """Weekly reach beside the calendar week before it."""
    before = F.lag("reach_pct").over(W.orderBy("week_no"))
    return adoption_weekly(events, settings).select(
        "week_no",
        "week_start",
        "reach_pct",
        before.alias("previous_reach_pct"),
        half_even(F.col("reach_pct") - before, 1).alias("change_pct"),
    )


def measure_adoption(
    events: DataFrame, settings: Adoption = Adoption(), facts: DataFrame | None = None
) -> dict[str, DataFrame]:
    facts = usage_facts(events, settings) if facts is None else facts
    return {
        "adoption_headline": adoption_headline(events, settings, facts),
        "adoption_weekly": adoption_weekly(events, settings, facts),
        "adoption_by_team": adoption_by_team(events, settings, facts),
    }
