"""Content digests that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.functions.dates import written

# Stands for a null; a text always begins with its length.
NULL_MARK = "-"


def _text(df: DataFrame, name: str) -> Column:
    """A field so written that no two values, and no two neighbours, run together."""
    kind = dict(df.dtypes)[name]
    value = written(F.col(name)) if kind.startswith("timestamp") else F.col(name).cast("string")
    return F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit(NULL_MARK))


def fingerprint(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row: the row count and a digest of `columns` over all rows.

    Both 64-bit halves of each row's MD5 are added up: rows in any order agree,
    and a row present twice counts twice. The sums are taken in decimals, which
    no row count overflows.
    """
    digest = F.md5(F.concat(*[_text(df, c) for c in columns]))
    halves = [
        F.coalesce(
            F.sum(F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)")), F.lit(0)
        ).cast("string")
        for at in (1, 17)
    ]
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *halves).alias("digest")
    ).select(F.lit(name).alias("input"), "rows", "digest")
