"""Every operator as a named query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.operators import adoption as usage_metrics
from tillspark.operators import basket, checks, measures, quality, security, semantic, star
from tillspark.operators import recommend as recs
from tillspark.operators import similarity
from tillspark.operators.measures import Model
from tillspark.plans import fixtures
from tillspark.plans.fixtures import ADOPTION, RECOMMEND, SEMANTIC, once
from tillspark.plans.refresh import input_fingerprints, refresh, run_metrics
from tillspark.settings import Recommend, Settings
from tillspark.sources.staging import stage
from tillspark.sources.transactions import extract_profile, type_lines
from tillspark.sources.usage import event_violations

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings(recommend=RECOMMEND, adoption=ADOPTION, semantic=SEMANTIC)
RUNNING_FIRST, RUNNING_LAST = "1996-03-01", "1997-02-15"
BUNDLE_CONFIDENCE, BUNDLE_BASKETS = 0.05, 2


BY_NAME = Recommend(min_confidence=0.02)


# --- shared inputs, each built once per application and data folder -------------


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "flagged",
        lambda: stage(quality.flag_lines(fixtures.lines(spark, sf)), "flagged"),
    )


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_lines(flagged(spark, sf))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quarantined_lines(flagged(spark, sf))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "fact", lambda: stage(star.fact_sales(clean(spark, sf)), "fact_sales")
    )


def product(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "product", lambda: stage(star.dim_product(clean(spark, sf)), "dim_product")
    )


def customer(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "customer", lambda: stage(star.dim_customer(clean(spark, sf)), "dim_customer")
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "items", lambda: stage(basket.basket_items(fact(spark, sf)), "items")
    )


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return once(
        spark, sf, "recs",
        lambda: stage(recs.recommend(fact(spark, sf), product(spark, sf), RECOMMEND), "recs"),
    )


def model(spark: SparkSession, sf: str) -> Model:
    return once(
        spark, sf, "model",
        lambda: semantic.build_model(
            fact(spark, sf), product(spark, sf), customer(spark, sf),
            quarantine(spark, sf), SEMANTIC,
        ),
    )


# --- queries ---------------------------------------------------------------------


def extract_typed(spark: SparkSession, sf: str) -> DataFrame:
    return type_lines(fixtures.raw_feed(spark, sf))


def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    rules = [r.name for r in quality.RULES]
    lines = quality.flag_lines(fixtures.lines(spark, sf))
    return lines.select(
        "invoice_no", "stock_code", "quantity", "unit_price", "customer_id",
        F.col("src_pos.l_linenumber").alias("line_number"),
        F.col("src_pos.copy_no").alias("copy_no"),
        *rules,
    )


def entry_results(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rule_results(quality.flag_lines(fixtures.lines(spark, sf)))


def _line_columns(df: DataFrame) -> DataFrame:
    return df.drop("p_name", "src_pos")


def _measure(name: str, *args) -> Query:
    return lambda spark, sf: getattr(measures, name)(model(spark, sf), *args)


def _semantic(name: str) -> Query:
    return lambda spark, sf: model(spark, sf)[name]


SLICES = {"Year": [1996], "Region": ["2. Europe"], "PriceBand": ["3. GBP 2.50 - 5", "5. GBP 10+"]}


def _sliced(name: str, *args) -> Query:
    return lambda spark, sf: getattr(measures, name)(
        once(spark, sf, "sliced", lambda: measures.sliced(model(spark, sf), **SLICES)), *args
    )


def _secured_measure(user: str, name: str) -> Query:
    return lambda spark, sf: getattr(measures, name)(security.secure(model(spark, sf), user))


def _secured(user: str, name: str) -> Query:
    return lambda spark, sf: security.secure(model(spark, sf), user)[name]


def co_purchase_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The default support count, on the few and busy part names."""
    named = clean(spark, sf).select("invoice_no", "p_name")
    return basket.co_purchase_rules(named, BY_NAME, product="p_name")


def content_similar(spark: SparkSession, sf: str) -> DataFrame:
    """Matches for products no basket rule at the default support covers."""
    rules = basket.co_purchase_rules(fact(spark, sf), Recommend())
    return similarity.content_similar(product(spark, sf), rules, Recommend()).select(
        "stock_code", "recommended_stock_code", "rank", "method"
    )


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.tfidf_terms(
        product(spark, sf).where(F.col("description") != star.UNKNOWN_DESCRIPTION),
        "stock_code",
        "description",
    ).select("stock_code", "term", "tf", "df", F.round("weight", 9).alias("weight"))


def tfidf_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Per term of all document texts: documents, uses and mean weight."""
    docs = fixtures.dealt(spark, sf, "documents", "doc_id").select("doc_id", "text")
    return (
        similarity.tfidf_terms(docs, "doc_id", "text")
        .groupBy("term")
        .agg(
            F.max("df").alias("df"),
            F.sum("tf").alias("uses"),
            F.round(F.avg("weight"), 7).alias("mean_weight"),
        )
    )


def run_metrics_row(spark: SparkSession, sf: str) -> DataFrame:
    headline = usage_metrics.adoption_headline(fixtures.usage(spark, sf), ADOPTION)
    return run_metrics(
        flagged(spark, sf), product(spark, sf), recommendations(spark, sf), headline, SETTINGS
    )


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Everything from the line view to the run's metrics, sharing nothing."""
    lines = stage(fixtures.build_lines(spark, sf), "lines")
    done = refresh(lines, fixtures.usage(spark, sf), SETTINGS)
    return done.metrics


def _usage(function: Callable) -> Query:
    return lambda spark, sf: function(fixtures.usage(spark, sf), ADOPTION)


QUERIES: dict[str, Query] = {
    # feed
    "extract_typed": extract_typed,
    "extract_profile": lambda s, d: extract_profile(fixtures.lines(s, d)),
    "event_violations": lambda s, d: event_violations(fixtures.faulty_usage(s, d), ADOPTION),
    "input_fingerprint": lambda s, d: input_fingerprints(
        fixtures.lines(s, d), fixtures.usage(s, d)
    ),
    # quality
    "dq_flags": dq_flags,
    "dq_results": entry_results,
    "dq_clean": lambda s, d: _line_columns(clean(s, d)),
    "dq_quarantine": lambda s, d: _line_columns(quarantine(s, d)),
    "dq_gate": lambda s, d: quality.gate(flagged(s, d)),
    # warehouse star
    "fact_sales": lambda s, d: star.fact_sales(clean(s, d)),
    "dim_product": lambda s, d: star.dim_product(clean(s, d)),
    "dim_customer": lambda s, d: star.dim_customer(clean(s, d)),
    "dim_date": lambda s, d: star.dim_date(clean(s, d)),
    "top_codes": lambda s, d: measures.top_codes(product(s, d)),
    # baskets and recommendations
    "basket_items": lambda s, d: basket.basket_stats(items(s, d)),
    "basket_pairs": lambda s, d: basket.pair_counts(items(s, d), RECOMMEND.max_basket_size),
    "co_purchase_rules": lambda s, d: basket.co_purchase_rules(fact(s, d), RECOMMEND),
    "co_purchase_by_name": co_purchase_by_name,
    "tfidf_terms": tfidf_terms,
    "tfidf_documents": tfidf_documents,
    "content_similar": content_similar,
    "recommendations": lambda s, d: recs.ordered(
        recs.recommend(fact(s, d), product(s, d), RECOMMEND)
    ),
    "rec_coverage": lambda s, d: recs.coverage(recommendations(s, d), product(s, d)),
    "rec_uncovered": lambda s, d: recs.uncovered(recommendations(s, d), product(s, d)),
    "rec_hubs": lambda s, d: recs.hubs(recommendations(s, d)),
    "bundle_candidates": lambda s, d: recs.bundle_candidates(
        recommendations(s, d), BUNDLE_CONFIDENCE, BUNDLE_BASKETS
    ),
    # adoption
    "adoption_as_of": lambda s, d: usage_metrics.as_of_frame(
        fixtures.usage(s, d), replace(ADOPTION, analysis_as_of=None)
    ),
    "effective_roster": _usage(usage_metrics.effective_roster),
    "adoption_headline": _usage(usage_metrics.adoption_headline),
    "adoption_weekly": _usage(usage_metrics.adoption_weekly),
    "adoption_by_team": _usage(usage_metrics.adoption_by_team),
    "reach_change": _usage(usage_metrics.reach_change),
    # semantic star
    "sem_dim_date": _semantic("dim_date"),
    "sem_dim_country": _semantic("dim_country"),
    "sem_dim_product": _semantic("dim_product"),
    "sem_dim_customer": _semantic("dim_customer"),
    "sem_dim_rule": _semantic("dim_quality_rule"),
    "sem_fact_sales": _semantic("fact_sales"),
    "sem_fact_quarantine": _semantic("fact_quarantine"),
    "sem_bridge": _semantic("bridge_quarantine_rule"),
    "sem_security": _semantic("security_user_country"),
    "orphan_codes": lambda s, d: semantic.orphan_codes(clean(s, d), quarantine(s, d)),
    "ri_checks": lambda s, d: checks.reference_checks(model(s, d)),
    "key_checks": lambda s, d: checks.key_checks(model(s, d)),
    "reconciliation": lambda s, d: checks.reconciliation(model(s, d)),
    # measures
    "sales_measures": _measure("sales_by"),
    "rev_by_month": _measure("sales_by", "YearMonth"),
    "rev_by_country": _measure("sales_by", "Country"),
    "rev_by_region": _measure("sales_by", "Region"),
    "rev_by_segment": _measure("sales_by", "CustomerSegment"),
    "rev_by_band": _measure("sales_by", "PriceBand"),
    "rev_by_product": _measure("sales_by", "Description"),
    "rev_by_day": _measure("revenue_by_day"),
    "rev_per_trading_day": _measure("revenue_per_trading_day"),
    "rev_ytd_mtd": _measure("revenue_to_date"),
    "rev_yoy": _measure("revenue_year_on_year"),
    "rev_yoy_daily": _measure("revenue_year_on_year_daily"),
    "rev_r3m": _measure("revenue_three_months"),
    "rev_r3m_daily": _measure("revenue_three_months_daily"),
    "rev_running": _measure("revenue_running_total", RUNNING_FIRST, RUNNING_LAST),
    "rev_share": _measure("revenue_share", "CustomerSegment", "PriceBand"),
    "product_rank": _measure("product_rank"),
    "top_products": _measure("top_products"),
    "top_customers": _measure("top_customers"),
    "top20_share": _measure("top_share"),
    "guest_measures": _measure("guest_measures"),
    "guest_by_country": _measure("guest_measures", "Country"),
    "dq_measures_by_rule": _measure("quality_by_rule"),
    "dq_measures": _measure("quality_measures"),
    # row-level security
    "rls_sales": _secured("three@example.com", "fact_sales"),
    "rls_sales_one": _secured("one@example.com", "fact_sales"),
    "rls_sales_all": _secured("all@example.com", "fact_sales"),
    "rls_sales_nobody": _secured("nobody@example.com", "fact_sales"),
    "rls_customers": _secured("three@example.com", "dim_customer"),
    "rls_countries": _secured("three@example.com", "dim_country"),
    "rls_quarantine": _secured("three@example.com", "fact_quarantine"),
    "rls_entitlements": _secured("three@example.com", "security_user_country"),
    # every user of a table of entitlements
    "sem_security_users": lambda s, d: semantic.security_user_country(
        model(s, d)["dim_country"], SEMANTIC, fixtures.entitlements(s, d)
    ),
    "rls_measures_by_user": lambda s, d: security.measures_by_user(
        model(s, d), fixtures.entitlements(s, d)
    ),
    # report cuts and time measures under group columns
    "rev_all_cuts": _measure("report_cuts"),
    "rev_ytd_mtd_by_region": _measure("revenue_to_date", "Region"),
    "rev_yoy_by_region": _measure("revenue_year_on_year", "Region"),
    "rev_yoy_by_product": _measure("revenue_year_on_year", "Description"),
    "rev_yoy_daily_by_region": _measure("revenue_year_on_year_daily", "Region"),
    "rev_r3m_by_segment_band": _measure("revenue_three_months", "CustomerSegment", "PriceBand"),
    "rev_r3m_daily_by_region": _measure("revenue_three_months_daily", "Region"),
    "rev_running_by_country": _measure(
        "revenue_running_total", RUNNING_FIRST, RUNNING_LAST, "Country"
    ),
    # slicers
    "rev_r3m_sliced": _sliced("revenue_three_months"),
    "rev_ytd_mtd_sliced": _sliced("revenue_to_date"),
    "rev_share_sliced": _sliced("revenue_share", "CustomerSegment", "PriceBand"),
    "product_rank_sliced": _sliced("product_rank"),
    "top20_share_sliced": _sliced("top_share"),
    # runs
    "run_metrics": run_metrics_row,
    "full_refresh": full_refresh,
}
for _user in ("one", "all", "nobody"):
    _mail = f"{_user}@example.com"
    QUERIES[f"rls_quality_measures_{_user}"] = _secured_measure(_mail, "quality_measures")
    QUERIES[f"rls_quality_by_rule_{_user}"] = _secured_measure(_mail, "quality_by_rule")
    QUERIES[f"rls_bridge_{_user}"] = _secured(_mail, "bridge_quarantine_rule")
