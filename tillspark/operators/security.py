"""Row-level security: what one user may see of the semantic star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.functions.numbers import in_units, ten_thousandths
from tillspark.operators.lookup import lookup, lookup_attributes, rows_at_most
from tillspark.operators.measures import _ROW, Model, with_rates
from tillspark.operators.semantic import ALL_COUNTRIES, UNKNOWN_KEY
from tillspark.sources.staging import stage


def secure(model: Model, user: str) -> Model:
    """The model as `user` sees it; an account without entitlements sees no sales.

    Countries and customers are filtered, and both filters reach the sales:
    a line shows when its country is visible and its customer is, guests always
    being so. Rejections follow their country, and the rule bridge shows the rows
    of visible rejections. The entitlement table shows a user their own rows only.
    """
    mine = model["security_user_country"].where(F.col("UserEmail") == user)
    everything = mine.agg(F.count_if(F.col("Country") == ALL_COUNTRIES) > 0).scalar()
    granted = mine.select("Country", F.lit(True).alias("_granted")).distinct()

    def visible(dim: DataFrame, extra=None) -> DataFrame:
        # One user's entitlements: a row per country at most.
        marked = dim.join(F.broadcast(granted), "Country", "left")
        seen = F.col("_granted").isNotNull() | everything
        return marked.where(seen if extra is None else seen | extra).select(*dim.columns)

    countries = stage(visible(model["dim_country"]), "visible_countries")
    customers = stage(visible(model["dim_customer"], F.col("IsGuest")), "visible_customers")

    def of_country(fact: DataFrame, row: list[str]) -> DataFrame:
        seen = countries.select("CountryKey", F.lit(True).alias("_country"))
        found = lookup(fact, seen, "CountryKey", row)
        return found.where("_country").drop("_country")

    sales = of_country(model["fact_sales"], _ROW)
    known = customers.select("CustomerKey", F.lit(True).alias("_customer"))
    sales = lookup_attributes(
        sales, known, "CustomerKey", _ROW, measured_on=model["fact_sales"], at_most=rows_at_most(known)
    )
    rejected = of_country(model["fact_quarantine"], ["QuarantineKey"]).select(
        *model["fact_quarantine"].columns
    )
    rejected = stage(rejected, "visible_quarantine")
    bridge = model["bridge_quarantine_rule"]
    return {
        **model,
        "bridge_quarantine_rule": bridge.join(
            rejected.select("QuarantineKey"), "QuarantineKey", "left_semi"
        ),
        "dim_country": countries,
        "dim_customer": customers,
        "security_user_country": mine,
        "fact_sales": sales.where("_customer").select(*model["fact_sales"].columns),
        "fact_quarantine": rejected,
    }


def visibility_cells(model: Model) -> DataFrame:
    """Sales lines with their `cell`: all that decides who sees them.

    A line's cell is its country and, unless it is a guest's, its customer's country. There are
    at most as many cells as pairs of countries, however many lines, customers or users.
    """
    sale = model["dim_country"].select("CountryKey", F.col("Country").alias("_sale"))
    home = model["dim_customer"].select(
        "CustomerKey", F.when(~F.col("IsGuest"), F.col("Country")).alias("_home"),
        F.col("IsGuest").alias("_guest"),
    )
    fact = model["fact_sales"]
    rows = fact
    for side, key in ((sale, "CountryKey"), (home, "CustomerKey")):
        rows = lookup_attributes(rows, side, key, _ROW, measured_on=fact, at_most=rows_at_most(side))
    cell = F.struct(
        F.col("_sale").alias("sale"), F.col("_home").alias("home"), F.col("_guest").alias("guest")
    )
    return rows.where("_sale is not null and _guest is not null").select(*fact.columns, cell.alias("cell"))


def granted_cells(cells: DataFrame, entitlements: DataFrame) -> DataFrame:
    """(UserEmail, cell) of every cell a user sees. `cells` holds each cell once."""
    grants = entitlements.select("UserEmail", "Country").distinct()
    sale = grants.withColumnRenamed("Country", "sale")
    home = grants.select("UserEmail", F.col("Country").alias("home"), F.lit(True).alias("_home"))
    flat = cells.select("cell", "cell.*")
    seen = (
        flat.join(sale, "sale")
        .join(home, ["UserEmail", "home"], "left")
        .where(F.col("guest") | F.col("_home"))
        .select("UserEmail", "cell")
    )
    # One value of at most as many cells as pairs of countries.
    every = cells.agg(F.collect_list("cell").alias("cells")).scalar()
    wild = grants.where(F.col("Country") == ALL_COUNTRIES).select(
        "UserEmail", F.explode(every).alias("cell")
    )
    return seen.unionByName(wild).distinct()


def measures_by_user(model: Model, entitlements: DataFrame | None = None) -> DataFrame:
    """The base measures of every entitled user, in one plan.

    Equal to the measures of `secure`, user by user. Lines are folded once, by cell, and users
    meet the fold, never the lines. Sums add up over cells. Invoices, customers and products are
    counted by the set of cells they occur in: a user sees one if any of its cells is visible,
    and things with the same set are one row with their number. `entitlements` (UserEmail,
    Country) replaces the model's own table.
    """
    if entitlements is None:
        entitlements = model["security_user_country"]
    rows = visibility_cells(model)
    folded = stage(
        rows.groupBy("cell").agg(
            F.sum(ten_thousandths(F.col("Revenue"))).alias("amount"),
            F.sum("Quantity").alias("units"),
            F.count(F.lit(1)).alias("lines"),
        ),
        "cells",
    )
    seen = stage(granted_cells(folded.select("cell"), entitlements), "granted_cells")
    sums = seen.join(folded, "cell").groupBy("UserEmail").agg(
        in_units(F.sum("amount")).alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.sum("lines").alias("_lines"),
    )
    out = entitlements.select("UserEmail").distinct().join(sums, "UserEmail", "left")
    out = out.withColumn("sales_lines", F.coalesce("_lines", F.lit(0))).drop("_lines")
    for key, name in (("InvoiceNo", "orders"), ("CustomerKey", "customers"), ("ProductKey", "products_sold")):
        things = rows.where(F.col(key).isNotNull())
        if key == "CustomerKey":
            things = things.where(F.col(key) != UNKNOWN_KEY)
        sets = things.groupBy(key).agg(F.array_sort(F.collect_set("cell")).alias("cells"))
        sets = sets.groupBy("cells").agg(F.count(F.lit(1)).alias("n"))
        held = sets.select("cells", "n", F.explode("cells").alias("cell"))
        counted = held.join(seen, "cell").select("UserEmail", "cells", "n").distinct()
        counted = counted.groupBy("UserEmail").agg(F.sum("n").alias(name))
        out = out.join(counted, "UserEmail", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return with_rates(out)
