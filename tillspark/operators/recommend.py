"""The recommendation table: basket rules, text matches for the rest, and its health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.functions.numbers import half_even, percent
from tillspark.operators.basket import co_purchase_rules
from tillspark.operators.lookup import BROADCAST_ROWS, lookup
from tillspark.operators.numbering import number_rows
from tillspark.operators.similarity import content_similar
from tillspark.operators.star import UNKNOWN_DESCRIPTION
from tillspark.settings import Recommend
from tillspark.sources.staging import stage, stage_counted

COLUMNS = (
    "stock_code", "description", "recommended_stock_code", "recommended_description",
    "rank", "method", "pair_baskets", "support", "confidence", "lift",
)


def recommend(
    fact: DataFrame,
    dim_product: DataFrame,
    settings: Recommend = Recommend(),
    products: int | None = None,
    rules: DataFrame | None = None,
) -> DataFrame:
    """Co-purchase rules, then description matches for products without any.

    `products` is the number of rows of a staged `dim_product`; without it the
    names are staged here. `rules` are the co-purchase rules, if they are written.
    """
    names = dim_product.select("stock_code", "description")
    if products is None:
        names, products = stage_counted(names, "names")
    if rules is None:
        rules = stage(co_purchase_rules(fact, settings, products=products), "rules")
    recs = rules.unionByName(content_similar(names, rules, settings))
    if products > BROADCAST_ROWS:
        recs = stage(recs, "unnamed")
    both = recs
    for prefix in ("", "recommended_"):
        code = f"{prefix}stock_code"
        names_there = names.toDF(code, f"{prefix}description")
        both = lookup(
            both, names_there, code, ["stock_code", "recommended_stock_code"],
            measured_on=recs, at_most=products,
        )
    rounded = {c: half_even(F.col(c), 5) for c in ("support", "confidence", "lift")}
    return both.withColumns(rounded).select(*COLUMNS)


def ordered(recs: DataFrame) -> DataFrame:
    return recs.orderBy("method", "stock_code", "rank")


def coverage(recs: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row: how much of the catalogue has a recommendation, and by which route."""
    covered = recs.groupBy("stock_code").agg(
        F.max(F.col("method") == "co_purchase").alias("_by_basket")
    )
    return (
        dim_product.select("stock_code", "description")
        .join(covered, "stock_code", "left")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.count("_by_basket").alias("covered_products"),
            F.count_if(F.col("_by_basket")).alias("co_purchase_products"),
            F.count_if(F.col("_by_basket").isNull()).alias("uncovered_products"),
            F.count_if(
                F.col("_by_basket").isNull() & (F.col("description") == UNKNOWN_DESCRIPTION)
            ).alias("uncovered_unknown"),
        )
        .withColumn("coverage_pct", percent(F.col("covered_products"), F.col("products")))
        .withColumn("co_purchase_pct", percent(F.col("co_purchase_products"), F.col("products")))
    )


def uncovered(recs: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Products no route reaches."""
    return dim_product.select("stock_code", "description").join(
        recs.select("stock_code").distinct(), "stock_code", "left_anti"
    )


def hubs(recs: DataFrame, top: int = 20) -> DataFrame:
    """The products recommended for most others by baskets, with their median lift.

    The median is read off a numbering of all rows by (product, lift): two
    numbers per product name its middle rows, wherever those rows are.
    """
    rules = recs.where(F.col("method") == "co_purchase").select(
        "recommended_stock_code", "lift", "stock_code"
    )
    order = [F.col("recommended_stock_code"), F.col("lift"), F.col("stock_code")]
    placed = number_rows(rules, order, "_at")
    extent = (
        placed.groupBy("recommended_stock_code")
        .agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("recommended_for"))
        .orderBy(F.col("recommended_for").desc(), "recommended_stock_code")
        .limit(top)
    )
    below = F.expr("_start + (recommended_for - 1) div 2")
    above = F.expr("_start + recommended_for div 2")
    middles = extent.select(
        "recommended_stock_code",
        "recommended_for",
        F.explode(F.array(below, above)).alias("_at"),
    )
    return (
        middles.join(placed.select("_at", "lift"), "_at")
        .groupBy("recommended_stock_code", "recommended_for")
        .agg((F.sum("lift") / 2).alias("median_lift"))
    )


def bundle_candidates(
    recs: DataFrame, min_confidence: float = 0.3, min_baskets: int = 50, top_n: int = 3
) -> DataFrame:
    """Rules already bought as a bundle: sure and frequent; the best few by lift."""
    strong = recs.where(
        (F.col("method") == "co_purchase")
        & (F.col("confidence") >= min_confidence)
        & (F.col("pair_baskets") >= min_baskets)
    )
    best = W.partitionBy("stock_code").orderBy(F.col("lift").desc(), "recommended_stock_code")
    return strong.withColumn("bundle_rank", F.row_number().over(best)).where(
        F.col("bundle_rank") <= top_n
    )
