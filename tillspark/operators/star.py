"""The warehouse star: one sales fact and its product, customer and date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.functions.dates import calendar, midnight, required
from tillspark.functions.numbers import exact_price, half_even, in_units, money_sum, ten_thousandths
from tillspark.operators.lookup import HOT_SLOTS, SPREAD, hot_values

UNKNOWN_DESCRIPTION = "UNKNOWN"
UNKNOWN_COUNTRY = "Unknown"


def fact_sales(clean: DataFrame) -> DataFrame:
    return clean.select(
        "invoice_no",
        "stock_code",
        "customer_id",
        midnight(F.col("invoice_ts")).alias("date_key"),
        "invoice_ts",
        "quantity",
        "unit_price",
        half_even(F.col("quantity") * F.col("unit_price"), 4).alias("revenue"),
        "country",
    )


def most_used(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the value on most rows; between equals the one that sorts first.

    Counted per (key, value) and then folded with a minimum, so neither step
    gathers the rows of a busy key.
    """
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))["v"]
    return counts.groupBy(key).agg(best.alias(value))


def dim_product(clean: DataFrame, hot_slots: int = HOT_SLOTS) -> DataFrame:
    """One row per product. `clean` should be read from a written table.

    Lines are shuffled once, by product, without running sums beside them, and folded where they
    arrive, by invoice and by description; only one row a product travels on. Lines of hot
    products are dealt out, and their invoices and descriptions counted by themselves.
    """
    hot = hot_values(clean, ["stock_code"], hot_slots)["stock_code"]
    busy = F.col("stock_code").isNull()
    if hot:
        busy = busy | F.col("stock_code").isin(*hot)
    # As many parts as a shuffle starts with: merged by their size they would not fit the folds.
    parts = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = 1 + F.pmod(F.xxhash64("invoice_no", "quantity", "unit_price", "invoice_ts"), F.lit(SPREAD))
    dealt = clean.select(
        "stock_code", "invoice_no", "description", "quantity", "unit_price",
        F.when(busy, deal).otherwise(0).alias("_part"),
    ).repartition(parts, "stock_code", "_part")
    quantity, price = F.col("quantity"), F.col("unit_price")
    none = lambda c: F.lit(None).cast(clean.schema[c].dataType).alias(c)
    # A line counts for its invoice, with its figures, and for its description.
    named = F.when(F.col("_part") == 0, F.col("description"))
    by_invoice = F.struct(F.lit(True).alias("_sold"), F.col("invoice_no").alias("_key"), quantity, price)
    by_name = F.struct(F.lit(False).alias("_sold"), named.alias("_key"), none("quantity"), none("unit_price"))
    counted = (
        dealt.select("stock_code", "_part", F.inline(F.array(by_invoice, by_name)))
        .groupBy("stock_code", "_part", "_sold", "_key")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("quantity").alias("_units"),
            F.sum(ten_thousandths(half_even(quantity * price, 4))).alias("_amount"),
            F.sum(exact_price(price)).alias("_prices"),
            F.count("unit_price").alias("_priced"),
        )
    )
    known = F.col("_key").isNotNull()
    folded = counted.groupBy("stock_code", "_part").agg(
        F.count_if(F.col("_sold") & known & (F.col("_part") == 0)).alias("_invoices"),
        F.sum("_units").alias("_units"),
        F.sum("_amount").alias("_amount"),
        F.sum("_prices").alias("_prices"),
        F.sum("_priced").alias("_priced"),
        F.min(
            F.when(~F.col("_sold") & known, F.struct((-F.col("_n")).alias("n"), F.col("_key").alias("v")))
        ).alias("_name"),
    )
    measures = folded.groupBy("stock_code").agg(
        F.sum("_invoices").alias("_invoices"),
        F.sum("_units").alias("units_sold"),
        in_units(F.sum("_amount")).alias("revenue"),
        F.try_divide(F.sum("_prices").cast("double"), F.sum("_priced").cast("double")).alias(
            "avg_unit_price"
        ),
        F.min("_name")["v"].alias("_name"),
    )
    # One row per hot product and one without a code.
    apart = clean.where(busy).groupBy(F.col("stock_code").alias("_code")).agg(
        F.count_distinct("invoice_no").alias("_apart")
    )
    names = most_used(clean.where(busy), "stock_code", "description")
    met = measures.join(
        F.broadcast(apart), F.col("stock_code").eqNullSafe(F.col("_code")), "left"
    ).join(F.broadcast(names), "stock_code", "left")
    return met.select(
        "stock_code", F.coalesce("_apart", "_invoices").alias("n_invoices"),
        "units_sold", "revenue", "avg_unit_price",
        F.coalesce("description", "_name", F.lit(UNKNOWN_DESCRIPTION)).alias("description"),
    )


def dim_customer(clean: DataFrame) -> DataFrame:
    known = fact_sales(clean).where(F.col("customer_id").isNotNull())
    measures = known.groupBy("customer_id").agg(
        F.count_distinct("invoice_no").alias("n_invoices"),
        money_sum(F.col("revenue")).alias("total_revenue"),
        F.min("invoice_ts").alias("first_order"),
        F.max("invoice_ts").alias("last_order"),
    )
    home = most_used(known, "customer_id", "country")
    return measures.join(home, "customer_id", "left").select(
        "customer_id",
        F.coalesce("country", F.lit(UNKNOWN_COUNTRY)).alias("country"),
        "n_invoices",
        "total_revenue",
        "first_order",
        "last_order",
    )


def dim_date(clean: DataFrame) -> DataFrame:
    """Every day from the first sale to the last, closed days included."""
    traded = clean.select(midnight(F.col("invoice_ts")).alias("date_key")).distinct()
    traded = traded.where(F.col("date_key").isNotNull())
    bounds = traded.agg(
        required(F.min("date_key"), "no valid timestamps, cannot build a calendar").alias("first"),
        F.max("date_key").alias("last"),
    )
    days = calendar(bounds, "date_key")
    day = F.col("date_key")
    return days.join(traded.withColumn("_sold", F.lit(True)), "date_key", "left").select(
        "date_key",
        F.col("_sold").isNotNull().alias("has_sales"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def build_star(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_sales": fact_sales(clean),
        "dim_product": dim_product(clean),
        "dim_customer": dim_customer(clean),
        "dim_date": dim_date(clean),
    }
