"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.llm import (
    decontamination,
    jaccard,
    mixing,
    ngrams,
    periodic,
    quality,
    retrieval,
    secrets,
    simhash,
    substrings,
    templates,
    warc,
    wrappers,
)
from tillspark.llm.text import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrappers.extract(table(spark, sf_dir, "pages"))
    return texts.select("*", F.length("text").cast("long").alias("n_chars"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 3)

    def count(kind: int):
        return F.coalesce(F.size(F.filter("spans", lambda x: x["kind"] == kind)), F.lit(0))

    none = F.array().cast(found.schema["spans"].dataType)
    return found.withColumn("spans", F.coalesce("spans", none)).select(
        "doc_id",
        count(0).cast("long").alias("n_assign"),
        count(1).cast("long").alias("n_access"),
        count(2).cast("long").alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda x: x["verdict"]), ",").alias("verdicts"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id"
    )


def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.drop_templates(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.hit_words()
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(table(spark, sf_dir, "documents"), change=periodic.repeating)
    first = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    named = found.withColumn(
        "longest",
        F.struct(first["start"].alias("start"), (-first["col1"]).alias("length"),
                 first["period"].alias("period")),
    )
    lines = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    exponent = F.expr("1000 * longest.length div longest.period")
    return named.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        exponent.alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_html_extraction,
        op2_secret_scan,
        op3_substring_dedup,
        op4_simhash,
        op5_quality_outliers,
        op6_line_templates,
        op7_ngram_scores,
        op8_decontamination,
        op9_mixing,
        op10_warc,
        op11_periodic_runs,
        op12_jaccard_join,
        op13_ranked_search,
    )
}
