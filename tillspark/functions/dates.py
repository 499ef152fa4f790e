"""Midnights and continuous calendars; all timestamps are without a zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def midnight(ts: Column) -> Column:
    """Midnight of the day, by way of the date: no time zone takes part."""
    return F.to_date(ts).cast(NTZ)


def week_start(ts: Column) -> Column:
    """Midnight of the Monday the timestamp's week began on."""
    return F.trunc(F.to_date(ts), "week").cast(NTZ)


def year_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "year").cast(NTZ)


def parsed(text: Column, pattern: str) -> Column:
    """The wall-clock time a text spells, null if it spells none.

    Read as if in UTC and counted from the epoch, so that an hour some session
    time zone skips is not moved.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{pattern} Z"))
    seconds = F.unix_micros(instant).cast("decimal(24,0)") / F.lit(1_000_000)
    zero = F.lit(0)
    epoch = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return epoch + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def written(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.ffffff`, always with six digits."""
    text = ts.cast("string")
    return F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")


def days_between(first: Column, last: Column, step: str = "interval 1 day") -> Column:
    return F.sequence(first, last, F.expr(step))


def calendar(bounds: DataFrame, out: str, step: str = "interval 1 day") -> DataFrame:
    """One row per step from `first` to `last`, both columns of the one-row `bounds`."""
    return bounds.select(
        F.explode(days_between(F.col("first"), F.col("last"), step)).alias(out)
    )


def required(value: Column, message: str) -> Column:
    """`value`, or an error at run time when it is null."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast(NTZ))
