"""The semantic star: surrogate keys, unknown members, a rejection fact and its rule bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.functions.dates import NTZ, calendar, midnight, required, year_start
from tillspark.functions.numbers import half_even
from tillspark.functions.rows import literal_rows
from tillspark.operators.lookup import BROADCAST_ROWS, lookup, lookup_all, rows_at_most
from tillspark.operators.numbering import number_rows, value_ranks
from tillspark.operators.quality import RULES, Rule
from tillspark.settings import (
    GUEST_SEGMENT,
    LAST_SEGMENT,
    PRICE_BANDS,
    REGION_LABELS,
    SEGMENTS,
    Semantic,
)
from tillspark.sources.staging import side_by_side, stage, stage_all
from tillspark.sources.transactions import SOURCE_POSITION

# The members every missing key points at.
UNKNOWN_KEY = -1
ALL_COUNTRIES = "*"
ALL_COUNTRIES_KEY = 0
GUEST_ID = "(guest)"
UNKNOWN_COUNTRY = "Unknown"
NON_PRODUCT_CODE = "(non-product)"
NON_PRODUCT_DESCRIPTION = "Non-product stock code (postage, fees, adjustments)"
NO_BAND = "0. Not applicable"

# What the semantic model reads of a rejected line.
REJECTED = (
    "invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts", "country", "reasons",
    SOURCE_POSITION,
)


def dim_date(fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Whole years around every date either fact holds, one row per day."""
    traded = fact.select(F.col("date_key").alias("Date")).distinct()
    seen = traded.unionByName(quarantine.select(F.col("invoice_ts").alias("Date")))
    bounds = seen.agg(F.min("Date").alias("a"), F.max("Date").alias("b")).select(
        year_start(required(F.col("a"), "no dates to build a calendar from")).alias("first"),
        F.make_date(F.year("b"), F.lit(12), F.lit(31)).cast(NTZ).alias("last"),
    )
    day = F.col("Date")
    days = calendar(bounds, "Date").join(
        traded.where(day.isNotNull()).withColumn("_traded", F.lit(True)), "Date", "left"
    )
    weekday = F.weekday(day) + 1
    return days.select(
        "Date",
        F.date_format(day, "yyyyMMdd").cast("int").alias("DateKey"),
        F.year(day).alias("Year"),
        F.quarter(day).alias("QuarterNo"),
        F.concat(F.year(day), F.lit(" Q"), F.quarter(day)).alias("Quarter"),
        F.month(day).alias("MonthNo"),
        F.date_format(day, "MMM").alias("MonthName"),
        F.date_format(day, "yyyy-MM").alias("YearMonth"),
        F.month(day).alias("MonthNameSort"),
        (F.year(day) * 100 + F.month(day)).alias("YearMonthSort"),
        F.dayofmonth(day).alias("DayOfMonth"),
        F.date_format(day, "EEE").alias("DayName"),
        weekday.alias("DayOfWeekNo"),
        weekday.alias("DayNameSort"),
        (weekday >= 6).alias("IsWeekend"),
        F.weekofyear(day).alias("ISOWeek"),
        F.col("_traded").isNotNull().alias("IsTradingDay"),
    )


def _region(country: Column, settings: Semantic) -> Column:
    return (
        F.when(country.isin(*settings.domestic), REGION_LABELS["domestic"])
        .when(country.isin(*settings.europe), REGION_LABELS["europe"])
        .when(country.isin(*settings.unspecified), REGION_LABELS["unspecified"])
        .otherwise(REGION_LABELS["rest"])
    )


def dim_country(
    fact: DataFrame, quarantine: DataFrame, settings: Semantic = Semantic()
) -> DataFrame:
    names = fact.select("country").unionByName(quarantine.select("country")).distinct()
    named = number_rows(names.where("country is not null"), [F.col("country")], "CountryKey")
    rows = named.select(
        "CountryKey",
        F.col("country").alias("Country"),
        _region(F.col("country"), settings).alias("Region"),
        F.col("country").isin(*settings.domestic).alias("IsDomestic"),
    )
    return _with_member(
        rows, (UNKNOWN_KEY, UNKNOWN_COUNTRY, REGION_LABELS["unspecified"], False)
    )


def _with_member(rows: DataFrame, member: tuple) -> DataFrame:
    """The unknown member, typed like the dimension, and the dimension's rows."""
    return literal_rows(rows.sparkSession, [member], rows.schema).unionByName(rows)


def price_band(price: Column) -> Column:
    """Label of the band a price falls in; a lower bound belongs to its band."""
    band = F.lit(None).cast("string")
    for low, label in PRICE_BANDS:
        band = F.when(price >= low, F.lit(label)).otherwise(band)
    return F.coalesce(band, F.lit("nan"))


def dim_product(product: DataFrame, fact: DataFrame) -> DataFrame:
    span = fact.groupBy("stock_code").agg(
        F.min("date_key").alias("FirstSoldDate"), F.max("date_key").alias("LastSoldDate")
    )
    described = product.select("stock_code", "description", "avg_unit_price")
    keyed = number_rows(
        described.join(span, "stock_code", "left"), [F.col("stock_code")], "ProductKey"
    )
    rows = keyed.select(
        "ProductKey",
        F.col("stock_code").alias("StockCode"),
        F.col("description").alias("Description"),
        F.col("avg_unit_price").alias("AvgUnitPrice"),
        price_band(F.col("avg_unit_price")).alias("PriceBand"),
        "FirstSoldDate",
        "LastSoldDate",
        F.lit(True).alias("IsSellable"),
    )
    return _with_member(
        rows,
        (UNKNOWN_KEY, NON_PRODUCT_CODE, NON_PRODUCT_DESCRIPTION, None, NO_BAND, None, None, False),
    )


def segment_floors(customer: DataFrame) -> DataFrame:
    """One row: the least revenue whose percentile rank exceeds each segment's bound.

    The percentile of a value is its average rank over the number of values:
    (values below + (peers + 1) / 2) / n. It grows with the value, so a
    customer's segment follows from comparing revenue with these floors and
    customers are never ranked row by row.
    """
    ranked = value_ranks(customer, "total_revenue")
    n = customer.agg(F.count("total_revenue").alias("n")).scalar()
    percentile = (F.col("below") + (F.col("peers") + 1) / 2.0) / n
    return ranked.agg(
        *[
            F.min(F.when(percentile > bound, F.col("total_revenue"))).alias(f"floor{at}")
            for at, (bound, _) in enumerate(SEGMENTS)
        ]
    )


def dim_customer(customer: DataFrame, country: DataFrame) -> DataFrame:
    floors = segment_floors(customer).first()
    segment = F.lit(LAST_SEGMENT)
    for at, (_, label) in reversed(list(enumerate(SEGMENTS))):
        floor = F.lit(floors[f"floor{at}"]).cast("double")
        segment = F.when(F.col("total_revenue") >= floor, F.lit(label)).otherwise(segment)
    homes = country.where(F.col("CountryKey") != UNKNOWN_KEY).select(
        F.col("Country").alias("country"), "CountryKey"
    )
    placed = lookup(customer, homes, "country", ["customer_id"], at_most=rows_at_most(country))
    rows = number_rows(placed, [F.col("customer_id")], "CustomerKey").select(
        "CustomerKey",
        F.col("customer_id").cast("string").alias("CustomerID"),
        F.coalesce("CountryKey", F.lit(UNKNOWN_KEY)).cast("long").alias("CountryKey"),
        F.when(
            F.col("CountryKey").isNotNull() | (F.col("country") == UNKNOWN_COUNTRY),
            F.col("country"),
        ).alias("Country"),
        segment.alias("CustomerSegment"),
        F.col("first_order").alias("FirstOrderDate"),
        F.col("last_order").alias("LastOrderDate"),
        F.lit(False).alias("IsGuest"),
    )
    return _with_member(
        rows,
        (UNKNOWN_KEY, GUEST_ID, UNKNOWN_KEY, UNKNOWN_COUNTRY, GUEST_SEGMENT, None, None, True),
    )


def dim_quality_rule(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per registered rule, in registry order."""
    capital = lambda text: text[:1].upper() + text[1:].lower()
    rows = [
        (
            at,
            rule.name,
            capital(rule.name.replace("_", " ")),
            capital(rule.dimension),
            "Quarantine" if rule.blocking else "Flag and keep",
            rule.why,
        )
        for at, rule in enumerate(rules, start=1)
    ]
    return literal_rows(
        spark,
        rows,
        "RuleKey long, RuleName string, RuleLabel string, QualityDimension string, "
        "Action string, Rationale string",
    )


def _key(name: str) -> Column:
    return F.coalesce(name, F.lit(UNKNOWN_KEY).cast("long")).alias(name)


def _keys(dim: DataFrame, key: str, natural: str, name: str) -> DataFrame:
    """The lookup side of a dimension: natural key renamed as the fact calls it."""
    known = dim.where(F.col(key) != UNKNOWN_KEY)
    return known.select(F.col(natural).alias(name), key)


def fact_sales(
    fact: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    country: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sales lines under surrogate keys. `fact` must be staged or published."""
    # Clean lines differ in these columns: whole copies are quarantined.
    row = ["invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts"]
    ids = F.col("CustomerID").cast("long")
    known = customer.where(F.col("CustomerKey") != UNKNOWN_KEY).withColumn("_id", ids)
    sides = [
        (_keys(product, "ProductKey", "StockCode", "stock_code"), "stock_code"),
        (_keys(known, "CustomerKey", "_id", "customer_id"), "customer_id"),
        (_keys(country, "CountryKey", "Country", "country"), "country"),
    ]
    return lookup_all(fact, sides, row, broadcast_rows).select(
        F.col("invoice_no").alias("InvoiceNo"),
        midnight(F.col("date_key")).alias("Date"),
        _key("ProductKey"),
        _key("CustomerKey"),
        _key("CountryKey"),
        F.col("quantity").cast("long").alias("Quantity"),
        half_even(F.col("unit_price"), 4).alias("UnitPrice"),
        half_even(F.col("revenue"), 4).alias("Revenue"),
    )


def number_quarantine(quarantine: DataFrame) -> DataFrame:
    """Rejected lines numbered 1..n in feed order."""
    return number_rows(quarantine, [F.col(SOURCE_POSITION)], "QuarantineKey")


def fact_quarantine(
    numbered: DataFrame,
    product: DataFrame,
    country: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rejected lines as a fact. `numbered` must be staged."""
    sides = [
        (_keys(product, "ProductKey", "StockCode", "stock_code"), "stock_code"),
        (_keys(country, "CountryKey", "Country", "country"), "country"),
    ]
    return lookup_all(numbered, sides, ["QuarantineKey"], broadcast_rows).select(
        "QuarantineKey",
        F.col("invoice_no").alias("InvoiceNo"),
        midnight(F.col("invoice_ts")).alias("Date"),
        _key("ProductKey"),
        _key("CountryKey"),
        F.col("quantity").cast("long").alias("Quantity"),
        half_even(F.col("unit_price"), 4).alias("UnitPrice"),
        # Not revenue: what would have been booked, negative for returns.
        half_even(F.col("quantity") * F.col("unit_price"), 4).alias("RejectedValue"),
    )


def bridge_quarantine_rule(numbered: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per rejected line and rule it broke; names no rule has are skipped."""
    broken = numbered.select("QuarantineKey", F.explode(F.split("reasons", ",")).alias("RuleName"))
    # The rule table is the registry in code: a handful of rows.
    return broken.join(F.broadcast(rules.select("RuleName", "RuleKey")), "RuleName").select(
        "QuarantineKey", "RuleKey"
    )


def security_user_country(
    country: DataFrame, settings: Semantic = Semantic(), entitlements: DataFrame | None = None
) -> DataFrame:
    """Who may see which country. `entitlements` (UserEmail, Country), a table of any size, takes
    the place of those in the settings; repeated grants count once."""
    granted = literal_rows(
        country.sparkSession, settings.entitlements, "UserEmail string, Country string"
    )
    if entitlements is not None:
        granted = entitlements.select("UserEmail", "Country").distinct()
    known = country.select("Country", "CountryKey")
    key = F.when(F.col("Country") == ALL_COUNTRIES, F.lit(ALL_COUNTRIES_KEY)).otherwise(
        F.coalesce("CountryKey", F.lit(UNKNOWN_KEY))
    )
    return granted.join(known, "Country", "left").select(
        "UserEmail", "Country", key.cast("long").alias("CountryKey")
    )


def orphan_codes(product: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Stock codes seen only among rejected lines. `product` may be the accepted lines as well:
    lines are folded to their codes before they are shuffled."""
    known = product.select("stock_code", F.lit(False).alias("_rejected"))
    seen = known.unionByName(quarantine.select("stock_code", F.lit(True).alias("_rejected")))
    only = seen.where("stock_code is not null").groupBy("stock_code").agg(
        F.bool_and("_rejected").alias("_only")
    )
    return only.where("_only").select("stock_code")


def build_model(
    fact: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    quarantine: DataFrame,
    settings: Semantic = Semantic(),
    rules: Sequence[Rule] = RULES,
    entitlements: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All nine tables from the four published ones, each staged once.

    Numbered dimensions are read from the table their numbering wrote.
    """
    country = dim_country(fact, quarantine, settings)
    first = side_by_side(
        fact.sparkSession,
        dim_date=lambda: stage(dim_date(fact, quarantine), "dim_date"),
        dim_product=lambda: dim_product(product, fact),
        dim_customer=lambda: dim_customer(customer, country),
        numbered=lambda: number_quarantine(quarantine.select(*REJECTED)),
    )
    products, customers = first["dim_product"], first["dim_customer"]
    numbered = first.pop("numbered")
    rule = dim_quality_rule(fact.sparkSession, rules)
    facts = stage_all(
        {
            "fact_sales": fact_sales(fact, products, customers, country),
            "fact_quarantine": fact_quarantine(numbered, products, country),
            "bridge_quarantine_rule": bridge_quarantine_rule(numbered, rule),
        }
    )
    return {
        **first,
        **facts,
        "dim_country": country,
        "dim_quality_rule": rule,
        "security_user_country": security_user_country(country, settings, entitlements),
    }
