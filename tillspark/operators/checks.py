"""Integrity of the semantic star: references, keys, the calendar, and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.functions.numbers import money_sum, ratio
from tillspark.operators.measures import Model
from tillspark.operators.semantic import UNKNOWN_KEY

REFERENCES = (
    ("fact_sales", "ProductKey", "dim_product"),
    ("fact_sales", "CustomerKey", "dim_customer"),
    ("fact_sales", "CountryKey", "dim_country"),
    ("fact_sales", "Date", "dim_date"),
    ("fact_quarantine", "ProductKey", "dim_product"),
    ("fact_quarantine", "Date", "dim_date"),
    ("bridge_quarantine_rule", "RuleKey", "dim_quality_rule"),
    ("bridge_quarantine_rule", "QuarantineKey", "fact_quarantine"),
)
KEYS = (
    ("dim_product", "ProductKey"),
    ("dim_customer", "CustomerKey"),
    ("dim_country", "CountryKey"),
    ("dim_date", "Date"),
    ("dim_quality_rule", "RuleKey"),
)


class IntegrityError(ValueError):
    """The star does not hold together."""


def reference_checks(model: Model) -> DataFrame:
    """Per foreign key, the child rows whose key the parent lacks; nulls do not count.

    Child rows are counted per key before the join, so a key on a third of all
    rows is one row when it meets its parent.
    """

    def orphans(child: str, key: str, parent: str) -> DataFrame:
        used = (
            model[child].where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        )
        lost = used.join(model[parent].select(key), key, "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
            F.lit(f"{child}.{key}").alias("check"), "orphans"
        )

    return reduce(DataFrame.unionByName, [orphans(*r) for r in REFERENCES])


def key_checks(model: Model) -> DataFrame:
    """Per dimension, how many keys occur twice; and the days the calendar skips."""

    def repeated(dim: str, key: str) -> DataFrame:
        twice = model[dim].groupBy(key).count().where(F.col("count") > 1)
        return twice.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"{dim}.{key}").alias("check"), "violations"
        )

    span = F.date_diff(F.max("Date"), F.min("Date")) + 1
    gaps = model["dim_date"].agg(
        F.coalesce(span - F.count_distinct("Date"), F.lit(0)).alias("violations")
    )
    contiguous = gaps.select(F.lit("dim_date contiguous").alias("check"), "violations")
    return reduce(DataFrame.unionByName, [*[repeated(*k) for k in KEYS], contiguous])


def reconciliation(model: Model) -> DataFrame:
    guest = F.col("CustomerKey") == UNKNOWN_KEY
    return (
        model["fact_sales"]
        .agg(
            money_sum(F.col("Revenue")).alias("revenue"),
            F.count_distinct("InvoiceNo").alias("invoices"),
            F.count(F.lit(1)).alias("sales_lines"),
            F.count_if(guest).alias("guest_rows"),
        )
        .withColumn("guest_share", ratio(F.col("guest_rows"), F.col("sales_lines")))
    )


def check_model(model: Model) -> None:
    """Raise, naming what broke, unless every check comes out at zero."""
    lost = reference_checks(model).where("orphans > 0").collect()
    bad = key_checks(model).where("violations > 0").collect()
    if lost or bad:
        named = [f"{r['check']}: {r['orphans']} orphan rows" for r in lost]
        named += [f"{r['check']}: {r['violations']} violations" for r in bad]
        raise IntegrityError("; ".join(named))
