"""The measure library over the semantic star.

Additive measures fold the fact first. Time measures run over the calendar, so
a closed day or an empty month keeps its place; after folding, a calendar has
one row per day or month, which is what the ordered windows below pass over.
A measure without data is null, never zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.functions.dates import NTZ
from tillspark.functions.numbers import in_units, money_sum, ratio, ten_thousandths
from tillspark.operators.lookup import hot_values, lookup, lookup_attributes, rows_at_most
from tillspark.operators.numbering import number_rows, value_ranks
from tillspark.operators.semantic import UNKNOWN_KEY
from tillspark.settings import NO_DATA_MESSAGE
from tillspark.sources.staging import stage

Model = dict[str, DataFrame]

# Keys in a word of a bitmap.
KEYS = 64
# The cuts the report pages show.
CUTS = ("YearMonth", "Country", "Region", "CustomerSegment", "PriceBand", "Description")

# Columns that tell the lines of the sales fact apart.
_ROW = ["InvoiceNo", "ProductKey", "Date", "Quantity", "UnitPrice"]
_DIMENSIONS = {
    "Date": "dim_date",
    "ProductKey": "dim_product",
    "CustomerKey": "dim_customer",
    "CountryKey": "dim_country",
}


def in_context(model: Model, *columns: str, fact: str = "fact_sales") -> DataFrame:
    """A fact with the dimension attributes it is to be sliced by.

    Country attributes come from the country of the sale; the customer's own
    country plays no part.
    """
    joined = rows = model[fact]
    row = ["QuarantineKey"] if fact == "fact_quarantine" else _ROW
    for key, name in _DIMENSIONS.items():
        if key not in rows.columns:
            continue
        dim = model[name]
        hidden = {"CountryKey", "Country"} if name == "dim_customer" else set()
        wanted = [
            c for c in columns if c in dim.columns and c not in joined.columns and c not in hidden
        ]
        if wanted:
            joined = lookup_attributes(
                joined, dim.select(key, *wanted), key, row, measured_on=rows, at_most=rows_at_most(dim)
            )
    return joined


def sliced(model: Model, **chosen: Sequence) -> Model:
    """The model under slicers, e.g. `Year=[1996], Region=["2. Europe"]`.

    Both facts are filtered through the dimensions that hold the columns; the
    dimensions stay whole, so that calendars keep their closed days.
    """
    out = dict(model)
    for name in ("fact_sales", "fact_quarantine"):
        fact = model[name]
        wide = in_context(model, *chosen, fact=name)
        held = [c for c in chosen if c in wide.columns]
        for column in held:
            wide = wide.where(F.col(column).isin(*chosen[column]))
        out[name] = stage(wide.select(*fact.columns), f"sliced_{name}")
    rejected = out["fact_quarantine"].select("QuarantineKey")
    out["bridge_quarantine_rule"] = model["bridge_quarantine_rule"].join(
        rejected, "QuarantineKey", "left_semi"
    )
    return out


def _met(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """`left` with the other columns of `right` for the same group, nulls being equal."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by], F.lit(True)
    )
    return left.join(renamed, same, "left").drop(*[f"_r_{c}" for c in by])


def key_words(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, word, bits): the surrogate keys of each group as bitmaps of 64 keys a word.

    Keys are dense, so a word takes the place of up to 64 rows, and words are merged like
    sums: no set of keys is held or shuffled.
    """
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(F.col(key), F.lit(KEYS)).cast("int")
    )
    word = F.floor(F.col(key) / KEYS).alias("word")
    return rows.where(F.col(key).isNotNull()).groupBy(*by, word).agg(F.bit_or(bit).alias("bits"))


def _keys_held(words: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    return words.groupBy(*by).agg(F.sum(F.bit_count("bits")).alias(out))


def sales_measures(sales: DataFrame, *by: str) -> DataFrame:
    """Base measures and the rates on them, per group or in total.

    Lines are folded to one row per group and invoice, which counts the invoices; customers
    and products are counted by bitmaps of their keys.
    """
    folded = sales.groupBy(*by, "InvoiceNo").agg(
        F.sum(ten_thousandths(F.col("Revenue"))).alias("_amount"),
        F.sum("Quantity").alias("_units"),
        F.count(F.lit(1)).alias("_lines"),
    )
    base = folded.groupBy(*by).agg(
        in_units(F.sum("_amount")).alias("revenue"),
        F.sum("_units").alias("units_sold"),
        F.count("InvoiceNo").alias("orders"),
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("sales_lines"),
    )
    known = sales.where(F.col("CustomerKey") != UNKNOWN_KEY)
    for rows, key, out in ((known, "CustomerKey", "customers"), (sales, "ProductKey", "products_sold")):
        base = _met(base, _keys_held(key_words(rows, by, key), by, out), by)
        base = base.withColumn(out, F.coalesce(out, F.lit(0)))
    return with_rates(base)


def with_rates(base: DataFrame) -> DataFrame:
    return base.withColumns(
        {
            "average_order_value": ratio(F.col("revenue"), F.col("orders")),
            "units_per_order": ratio(F.col("units_sold"), F.col("orders")),
            "average_selling_price": ratio(F.col("revenue"), F.col("units_sold")),
            "lines_per_order": ratio(F.col("sales_lines"), F.col("orders")),
        }
    )


def report_cuts(model: Model, *cuts: str) -> DataFrame:
    """The base measures under every one of `cuts` (CUTS without any) and in total.

    One row per cut and member: `cut` names the column, "" the total, `member` its value as
    text. For the sums and orders, lines are shuffled once, by invoice, and meet all cuts where
    they arrive; those of hot invoices are folded before they move. Grouping sets give the
    bitmaps of customers and products in a pass each.
    """
    cuts = cuts or CUTS
    context = in_context(model, *cuts)
    sales = context.select(
        "InvoiceNo", "ProductKey", "CustomerKey", "Quantity", "Revenue",
        *[F.col(c).cast("string").alias(c) for c in cuts],
    )

    def cut(rows: DataFrame, *extra: str):
        sets = [[c, *extra] for c in cuts] + [list(extra)]
        return rows.groupingSets(sets, *cuts, *extra)

    # Which column a grouping set keeps shows in the bits of its id, the first column highest.
    width = len(cuts)
    names = [F.when(F.col("_set").bitwiseAND(F.lit(1 << (width - 1 - k))) == 0, F.lit(c))
             for k, c in enumerate(cuts)]
    set_of = lambda extra: F.shiftright(F.grouping_id(), extra).alias("_set")
    labelled = lambda rows: rows.select(
        F.coalesce(*names, F.lit("")).alias("cut"), F.coalesce(*cuts).alias("member"),
        *[c for c in rows.columns if c not in (*cuts, "_set")],
    )
    by = ("cut", "member")
    hot = hot_values(model["fact_sales"], ["InvoiceNo"])["InvoiceNo"]
    busy = F.col("InvoiceNo").isNull()
    if hot:
        busy = busy | F.col("InvoiceNo").isin(*hot)
    # As many parts as a shuffle starts with: merged by their size they would not fit the folds.
    parts = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = sales.select("InvoiceNo", "Quantity", "Revenue", *cuts)
    members = [F.struct(F.lit(c).alias("cut"), F.col(c).alias("member")) for c in cuts]
    total = F.struct(F.lit("").alias("cut"), F.lit(None).cast("string").alias("member"))

    def folds(rows: DataFrame) -> DataFrame:
        seen = rows.select("InvoiceNo", "Quantity", "Revenue", F.inline(F.array(*members, total)))
        return seen.groupBy("InvoiceNo", *by).agg(
            F.sum(ten_thousandths(F.col("Revenue"))).alias("_amount"),
            F.sum("Quantity").alias("_units"),
            F.count(F.lit(1)).alias("_lines"),
        )

    folded = folds(lines.where(~busy).repartition(parts, "InvoiceNo")).unionByName(
        folds(lines.where(busy))
    )
    base = folded.groupBy(*by).agg(
        in_units(F.sum("_amount")).alias("revenue"),
        F.sum("_units").alias("units_sold"),
        F.count("InvoiceNo").alias("orders"),
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("sales_lines"),
    )
    for key, out in (("CustomerKey", "customers"), ("ProductKey", "products_sold")):
        rows = sales if key == "ProductKey" else sales.where(F.col(key) != UNKNOWN_KEY)
        place = F.pmod(F.col(key), F.lit(KEYS)).cast("int")
        rows = rows.select(
            *cuts, F.floor(F.col(key) / KEYS).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("bit"),
        )
        words = labelled(cut(rows, "word").agg(set_of(1), F.bit_or("bit").alias("bits")))
        base = _met(base, _keys_held(words, by, out), by).withColumn(out, F.coalesce(out, F.lit(0)))
    return with_rates(base)


def sales_by(model: Model, *columns: str) -> DataFrame:
    return sales_measures(in_context(model, *columns), *columns)


def _day_revenue(model: Model, *by: str) -> DataFrame:
    """Every calendar day with its revenue, null where nothing was sold.

    With group columns, every day of each group that ever sold anything.
    """
    if not by:
        sold = model["fact_sales"].groupBy("Date").agg(money_sum(F.col("Revenue")).alias("revenue"))
        return model["dim_date"].join(sold, "Date", "left")
    sold = in_context(model, *by).groupBy("Date", *by).agg(money_sum(F.col("Revenue")).alias("revenue"))
    sold = stage(sold, "group_days")
    calendar = model["dim_date"]
    first, last = (calendar.agg(f("Date").alias("d")).scalar() for f in (F.min, F.max))
    day = F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("Date")
    days = sold.select(*by).distinct().select(*by, day)
    return _met(days, sold, ["Date", *by]).join(calendar.drop(*by), "Date")


def _month_revenue(model: Model, *by: str) -> DataFrame:
    """Every calendar month with its revenue and trading days."""
    return (
        _day_revenue(model, *by)
        .groupBy(*by, "YearMonthSort", "YearMonth")
        .agg(
            money_sum(F.col("revenue")).alias("revenue"),
            F.count_if("IsTradingDay").alias("trading_days"),
        )
    )


def _running(value: str, over) -> Column:
    return in_units(F.sum(ten_thousandths(F.col(value))).over(over))


def revenue_by_day(model: Model, *by: str) -> DataFrame:
    """Revenue per calendar day, with a sentence where there is none."""
    message = F.when(F.col("revenue").isNull(), F.lit(NO_DATA_MESSAGE)).otherwise("")
    return _day_revenue(model, *by).select(*by, "Date", "revenue", message.alias("no_data_message"))


def revenue_to_date(model: Model, *by: str) -> DataFrame:
    """Revenue since the start of the year and of the month, for every day."""
    year = W.partitionBy(*by, "Year").orderBy("Date")
    month = W.partitionBy(*by, "YearMonthSort").orderBy("Date")
    return _day_revenue(model, *by).select(
        *by,
        "Date",
        "revenue",
        _running("revenue", year).alias("revenue_ytd"),
        _running("revenue", month).alias("revenue_mtd"),
    )


def _growth() -> Column:
    prior = F.col("revenue_ly")
    return F.when(
        prior.isNotNull() & (prior != 0),
        ratio(F.coalesce("revenue", F.lit(0.0)) - prior, prior),
    )


def revenue_year_on_year(model: Model, *by: str) -> DataFrame:
    """Each calendar month beside the same month a year earlier.

    The calendar covers whole years without a gap, so that is twelve rows back.
    """
    months = W.partitionBy(*by).orderBy("YearMonthSort")
    compared = _month_revenue(model, *by).withColumn("revenue_ly", F.lag("revenue", 12).over(months))
    return compared.select(*by, "YearMonth", "revenue", "revenue_ly", _growth().alias("yoy"))


def revenue_year_on_year_daily(model: Model, *by: str) -> DataFrame:
    """Each day beside the same day a year earlier; 29 February beside the 28th."""
    days = _day_revenue(model, *by).select(*by, "Date", "revenue")
    prior = days.select(*by, F.col("Date").alias("_prior"), F.col("revenue").alias("revenue_ly"))
    year_ago = F.add_months("Date", -12).cast(NTZ)
    compared = _met(days.withColumn("_prior", year_ago), prior, ["_prior", *by])
    return compared.select(*by, "Date", "revenue", "revenue_ly", _growth().alias("yoy"))


def revenue_three_months(model: Model, *by: str) -> DataFrame:
    """Revenue of each calendar month and the two before it."""
    window = W.partitionBy(*by).orderBy("YearMonthSort").rowsBetween(-2, 0)
    return _month_revenue(model, *by).select(
        *by, "YearMonth", "revenue", _running("revenue", window).alias("revenue_r3m")
    )


def revenue_three_months_daily(model: Model, *by: str) -> DataFrame:
    """Revenue of the three months ending on each day.

    Each calendar day is handed to the days whose window holds it: some ninety
    per day, of a calendar already folded to one row per day.
    """
    days = _day_revenue(model, *by).select(*by, "Date", "revenue")
    start = (F.add_months("Date", -3) + F.expr("interval 1 day")).cast(NTZ)
    held = days.select(
        *by,
        F.col("Date").alias("_end"),
        F.explode(F.sequence(start, F.col("Date"), F.expr("interval 1 day"))).alias("Date"),
    )
    sums = _met(held, days, ["Date", *by]).groupBy(*by, F.col("_end").alias("Date")).agg(
        money_sum(F.col("revenue")).alias("revenue_r3m")
    )
    return _met(days, sums, ["Date", *by])


def revenue_running_total(model: Model, first: str, last: str, *by: str) -> DataFrame:
    """Cumulative revenue inside a selection of days, starting from nothing."""
    chosen = _day_revenue(model, *by).where(
        (F.col("Date") >= F.lit(first).cast(NTZ)) & (F.col("Date") <= F.lit(last).cast(NTZ))
    )
    over = W.partitionBy(*by).orderBy("Date")
    return chosen.select(*by, "Date", "revenue", _running("revenue", over).alias("running_total"))


def revenue_per_trading_day(model: Model) -> DataFrame:
    """Monthly revenue over the days of the month on which anything was sold."""
    return _month_revenue(model).select(
        "YearMonth",
        "revenue",
        "trading_days",
        ratio(F.col("revenue"), F.col("trading_days")).alias("revenue_per_trading_day"),
    )


def revenue_share(model: Model, *columns: str) -> DataFrame:
    """Revenue per country and `columns`, as a share of all and of its country."""
    cells = (
        in_context(model, "Country", *columns)
        .groupBy("Country", *columns)
        .agg(money_sum(F.col("Revenue")).alias("revenue"))
    )
    countries = (
        in_context(model, "Country")
        .groupBy("Country")
        .agg(money_sum(F.col("Revenue")).alias("_country"))
    )
    total = model["fact_sales"].select(money_sum(F.col("Revenue")).alias("n")).scalar()
    return cells.join(stage(countries, "countries"), "Country").select(
        "Country",
        *columns,
        "revenue",
        ratio(F.col("revenue"), total).alias("share_of_total"),
        ratio(F.col("revenue"), F.col("_country")).alias("share_of_country"),
    )


def _product_revenue(model: Model) -> DataFrame:
    """Revenue per product key, folded before any product attribute is joined."""
    return model["fact_sales"].groupBy("ProductKey").agg(
        money_sum(F.col("Revenue")).alias("revenue")
    )


def product_rank(model: Model) -> DataFrame:
    """Dense rank of descriptions by revenue.

    Only distinct revenues are numbered; descriptions then look theirs up.
    """
    named = _product_revenue(model).join(
        model["dim_product"].select("ProductKey", "Description"), "ProductKey"
    )
    totals = stage(
        named.groupBy("Description").agg(money_sum(F.col("revenue")).alias("revenue")), "ranked"
    )
    values = totals.select("revenue").distinct()
    ranks = number_rows(values, [F.col("revenue").desc()], "revenue_rank")
    return lookup(totals, ranks, "revenue", ["Description"]).select(
        "Description", "revenue", "revenue_rank"
    )


def top_products(model: Model, n: int = 15) -> DataFrame:
    return product_rank(model).orderBy("revenue_rank", "Description").limit(n)


def top_customers(model: Model, n: int = 15) -> DataFrame:
    """Named customers by revenue, with their orders and average order value."""
    known = model["fact_sales"].where(F.col("CustomerKey") != UNKNOWN_KEY)
    best = (
        known.groupBy("CustomerKey")
        .agg(
            money_sum(F.col("Revenue")).alias("revenue"),
            F.count_distinct("InvoiceNo").alias("orders"),
        )
        .orderBy(F.col("revenue").desc(), "CustomerKey")
        .limit(n)
    )
    return best.join(model["dim_customer"].select("CustomerKey", "CustomerID"), "CustomerKey").select(
        "CustomerID",
        "revenue",
        "orders",
        ratio(F.col("revenue"), F.col("orders")).alias("average_order_value"),
    )


def top_codes(dim_product: DataFrame, n: int = 400) -> DataFrame:
    """The stock codes on most invoices, from the warehouse product dimension."""
    return (
        dim_product.select("stock_code", "n_invoices")
        .orderBy(F.col("n_invoices").desc(), "stock_code")
        .limit(n)
    )


def top_share(model: Model, top: float = 0.2) -> DataFrame:
    """The share of revenue the best-selling fifth of the products brings in.

    Products are ranked with gaps, those without revenue last; the fifth is of
    products with revenue. Works on counts of equal revenues.
    """
    products = stage(_product_revenue(model), "product_revenue")
    selling = products.where(F.col("revenue") > 0).select(F.count(F.lit(1)).alias("n")).scalar()
    everyone = products.select(F.count(F.lit(1)).alias("n")).scalar()
    ranked = value_ranks(products, "revenue").withColumn(
        "_rank", everyone - F.col("below") - F.col("peers") + 1
    )
    amount = ten_thousandths(F.col("revenue")) * F.col("peers")
    chosen = F.col("_rank") <= selling * F.lit(top)
    return ranked.agg(
        F.sum(F.when(chosen, F.col("peers"))).alias("top_products"),
        in_units(F.sum(F.when(chosen, amount))).alias("top_revenue"),
        in_units(F.sum(amount)).alias("revenue"),
    ).withColumn("top_share", ratio(F.col("top_revenue"), F.col("revenue")))


def guest_measures(model: Model, *by: str) -> DataFrame:
    """Revenue without and with a customer id, and the share of the former."""
    guest = F.col("CustomerKey") == UNKNOWN_KEY
    amounts = in_context(model, *by).groupBy(*by).agg(
        money_sum(F.when(guest, F.col("Revenue"))).alias("guest_revenue"),
        money_sum(F.when(~guest, F.col("Revenue"))).alias("identified_revenue"),
        money_sum(F.col("Revenue")).alias("revenue"),
    )
    return amounts.withColumn("guest_share", ratio(F.col("guest_revenue"), F.col("revenue")))


def quality_by_rule(model: Model) -> DataFrame:
    """Rejections per rule. A row counts under every rule it broke.

    A blocking rule that rejected nothing shows 0; for a rule that only flags,
    rejection does not apply and the cell stays null.
    """
    values = model["fact_quarantine"].select("QuarantineKey", "RejectedValue")
    per_rule = (
        model["bridge_quarantine_rule"]
        .join(values, "QuarantineKey")
        .groupBy("RuleKey")
        .agg(
            F.count_distinct("QuarantineKey").alias("_rejected"),
            F.count(F.lit(1)).alias("rule_violations"),
            money_sum(F.col("RejectedValue")).alias("rejected_value"),
        )
    )
    rejected = F.when(
        F.col("Action") == "Quarantine", F.coalesce("_rejected", F.lit(0))
    ).otherwise(F.col("_rejected"))
    return (
        model["dim_quality_rule"]
        .join(per_rule, "RuleKey", "left")
        .select(
            "RuleKey",
            "RuleName",
            "Action",
            rejected.alias("rejected_rows"),
            "rule_violations",
            ratio(F.col("rule_violations"), rejected).alias("rules_per_row"),
            "rejected_value",
        )
    )


def quality_measures(model: Model, ceiling: float = 0.30) -> DataFrame:
    """One row over both facts: what was extracted, rejected, and at what rate."""
    bridge = model["bridge_quarantine_rule"]
    rejected_lines = model["fact_quarantine"].join(
        bridge.select("QuarantineKey").distinct(), "QuarantineKey", "left_semi"
    )
    broken = bridge.agg(
        F.count_distinct("QuarantineKey").alias("rejected_rows"),
        F.count(F.lit(1)).alias("rule_violations"),
    )
    sales = model["fact_sales"].agg(F.count(F.lit(1)).alias("n"), F.max("Date").alias("d"))
    value = rejected_lines.select(money_sum(F.col("RejectedValue")).alias("n")).scalar()
    blocking = model["dim_quality_rule"].agg(
        F.count_if(F.col("Action") == "Quarantine").alias("n")
    )
    extracted = F.col("sales_lines") + F.col("rejected_rows")
    rate = ratio(F.col("rejected_rows"), extracted)
    return broken.withColumns(
        {
            "sales_lines": sales.select("n").scalar(),
            "rejected_value": value,
            "blocking_rules": blocking.scalar(),
            "last_refresh": sales.select("d").scalar(),
        }
    ).select(
        "rejected_rows",
        "rule_violations",
        ratio(F.col("rule_violations"), F.col("rejected_rows")).alias("rules_per_row"),
        "rejected_value",
        extracted.alias("rows_extracted"),
        rate.alias("quarantine_rate"),
        (rate - ceiling).alias("rate_vs_threshold"),
        "blocking_rules",
        "last_refresh",
    )
