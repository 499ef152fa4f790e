"""A full refresh: lines and usage in, warehouse tables and run metrics out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.functions.numbers import percent
from tillspark.operators.adoption import measure_adoption
from tillspark.operators.basket import co_purchase_rules
from tillspark.operators.checks import IntegrityError, check_model
from tillspark.operators.fingerprint import fingerprint
from tillspark.operators.quality import (
    QualityGateError,
    clean_lines,
    enforce_gate,
    gate,
    quarantined_lines,
    rule_results,
    stage_flagged,
)
from tillspark.operators.recommend import coverage, recommend
from tillspark.operators.semantic import build_model
from tillspark.operators.star import build_star
from tillspark.settings import Settings
from tillspark.sources.published import export_csv, publish, read_published
from tillspark.sources.records import check_rejects
from tillspark.sources.staging import side_by_side, stage, stage_all, staging_area, written_rows
from tillspark.sources.transactions import check_lines, read_lines, read_lines_kept
from tillspark.sources.usage import METRIC_COLUMNS, check_events, read_usage, read_usage_kept

LINE_COLUMNS = (
    "invoice_no", "stock_code", "description", "quantity", "invoice_ts", "unit_price",
    "customer_id", "country",
)


@dataclass(frozen=True)
class Refresh:
    tables: dict[str, DataFrame]
    results: DataFrame
    metrics: DataFrame


def run_metrics(
    flagged: DataFrame,
    products: DataFrame,
    recs: DataFrame,
    headline: DataFrame,
    settings: Settings = Settings(),
    counts: DataFrame | None = None,
) -> DataFrame:
    """One row describing a run: rows in and out, catalogue coverage, adoption."""
    covered = coverage(recs, products)
    value = F.col("value")
    adoption = headline.agg(
        *[
            F.max(F.when(F.col("metric") == name, value)).alias(name)
            for name in ("reach_pct", "activation_pct", "action_rate_pct", "csat")
        ]
    )
    return gate(flagged, settings.quality, counts=counts).select(
        "rows_source",
        "rows_quarantined",
        F.coalesce(percent(F.col("rows_quarantined"), F.col("rows_source"), 2), F.lit(0.0)).alias(
            "quarantine_rate_pct"
        ),
        "rows_loaded",
        covered.select("products").scalar().alias("products"),
        recs.select(F.count(F.lit(1)).alias("n")).scalar().alias("recommendations"),
        F.coalesce(covered.select("coverage_pct").scalar(), F.lit(0.0)).alias(
            "catalogue_coverage_pct"
        ),
        *[adoption.select(c).scalar().alias(c) for c in adoption.columns],
    )


def input_fingerprints(lines: DataFrame, events: DataFrame) -> DataFrame:
    return fingerprint(lines, list(LINE_COLUMNS), "lines").unionByName(
        fingerprint(events, list(METRIC_COLUMNS), "usage")
    )


def refresh(lines: DataFrame, events: DataFrame, settings: Settings = Settings()) -> Refresh:
    """Flag, gate, split, model, recommend and measure. Raises at the gate.

    Every table and the rule results are computed and staged; so should `lines` be.
    Steps that do not read each other's tables run side by side.
    """
    done = side_by_side(
        lines.sparkSession,
        lines=lambda: _line_tables(lines, settings),
        adoption=lambda: stage_all(measure_adoption(events, settings.adoption)),
    )
    flagged, counts, tables = done["lines"]
    tables |= done["adoption"]
    metrics = run_metrics(
        flagged, tables["dim_product"], tables["recommendations"], tables["adoption_headline"],
        settings, counts,
    )
    return Refresh(tables, rule_results(flagged, counts=counts), metrics)


def _line_tables(
    lines: DataFrame, settings: Settings
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Flagged lines, their counts, and every table made of them; raises at the gate."""
    flagged, counts = stage_flagged(lines, settings.quality)
    enforce_gate(flagged, settings.quality, counts=counts)
    star = build_star(clean_lines(flagged))
    quarantine = quarantined_lines(flagged)
    rules = lambda: co_purchase_rules(star["fact_sales"], settings.recommend)
    # The rules take longest and are needed next, so their jobs are the first in the queue.
    tables = side_by_side(
        lines.sparkSession,
        rules=lambda: stage(rules(), "rules"),
        **{name: partial(stage, df, name) for name, df in star.items()},
        quarantine=lambda: stage(quarantine, "quarantine"),
    )
    known, products = tables.pop("rules"), tables["dim_product"]
    recs = recommend(
        tables["fact_sales"], products, settings.recommend, written_rows(products), known
    )
    return flagged, counts, {**tables, "recommendations": stage(recs, "recommendations")}


def refresh_files(
    spark: SparkSession,
    lines_csv: str,
    usage_csv: str,
    root: str,
    run_id: str,
    settings: Settings = Settings(),
) -> dict:
    """Refresh from the two CSV feeds and publish under `root`; returns the manifest.

    The rule results are published with the tables. If the gate fails they are
    written to `failed/<run_id>/quality_results`, and the version that is being
    read stays. With `extract.max_reject_rate`, records that cannot be read are
    published as `rejected_records` and counted by file in the manifest.
    """
    limit = settings.extract.max_reject_rate
    with staging_area(spark):
        extra, rejected = {}, {}
        if limit is None:
            lines = stage(read_lines(spark, lines_csv, settings.extract), "lines")
            events = stage(read_usage(spark, usage_csv), "usage")
        else:
            lines, bad_lines = read_lines_kept(spark, lines_csv, settings.extract)
            events, bad_events = read_usage_kept(spark, usage_csv)
            rejected = check_rejects(bad_lines, limit) | check_rejects(bad_events, limit)
            lines, events = stage(lines, "lines"), stage(events, "usage")
            extra = {"rejected_records": bad_lines.unionByName(bad_events)}
        check_lines(lines, settings.extract)
        check_events(events, settings.adoption)
        try:
            done = refresh(lines, events, settings)
        except QualityGateError as failed:
            failed.results.write.mode("overwrite").parquet(f"{root}/failed/{run_id}/quality_results")
            raise
        inputs = {
            r["input"]: [r["rows"], r["digest"]]
            for r in input_fingerprints(lines, events).collect()
        }
        metrics = {**done.metrics.first().asDict(), "inputs": inputs}
        if limit is not None:
            metrics["rejected"] = rejected
        tables = {**done.tables, "quality_results": done.results, **extra}
        return publish(spark, root, run_id, tables, metrics)


def semantic_from_published(
    spark: SparkSession,
    root: str,
    settings: Settings = Settings(),
    entitlements: DataFrame | None = None,
    export: str | None = None,
) -> dict[str, DataFrame]:
    """The semantic star over the version currently published under `root`.

    Raises, naming the tables, when keys are lost or doubled. `entitlements` (UserEmail,
    Country) replaces the list in the settings. With `export`, a new folder, the nine tables
    are written there as CSV, once they are checked.
    """
    names = ("fact_sales", "dim_product", "dim_customer", "quarantine")
    fact, product, customer, quarantine = (read_published(spark, root, n) for n in names)
    for name, dim, key in (
        ("dim_product", product, "stock_code"), ("dim_customer", customer, "customer_id"),
    ):
        if dim.groupBy(key).count().where("count > 1").limit(1).count():
            raise IntegrityError(f"published {name} holds a {key} twice")
    model = build_model(
        fact, product, customer, quarantine, settings.semantic, entitlements=entitlements
    )
    check_model(model)
    if export:
        export_csv(model, export)
    return model
