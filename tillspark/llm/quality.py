"""Quality rules: base limits, and robust multivariate outliers per language and source.

Every document gets a vector of transformed statistics. For each (language,
source) a minimum-covariance-determinant estimate is fitted: start from the 75 %
of documents nearest to the coordinate-wise medians, then repeat concentration
steps (mean and covariance of the subset; the subset becomes the 75 % with the
smallest Mahalanobis distance). The covariance is scaled so that the median
distance is that of the chi-squared law, and documents beyond `CUTOFF` go.

Statistics, covariances and distances are column expressions; each step is two
grouped aggregates, so no group, however large, meets in one task. Quantiles come
from Spark's mergeable sketch. `LEAST_SPREAD` is added to the diagonal, so
statistics that hardly vary within a group (symbols, repeats) reject only real
excess. Cells of fewer than `LEAST_ROWS` documents are fitted together per
language; where even those are too few, they are judged by an estimate over all
documents of the language, and if that is too small, over all documents. Only
with too few of these do the base limits alone apply.

Null texts have no words and fail the base limits; null languages and sources
are cells of their own. Repeated rows get the same verdict. Nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.text import words
from tillspark.sources.staging import stage, stage_counted

LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SUBSET = 0.75
STEPS = 3
LEAST_ROWS = 60
#: 0.999999 quantile and median of the chi-squared law with 5 degrees of freedom.
CUTOFF = 35.89
MEDIAN = 4.351
#: Spread that a statistic has at least: log words, log word length, symbols a word,
#: share of repeated lines, share of repeated words.
LEAST_SPREAD = (0.5, 0.15, 0.03, 0.1, 0.1)
SMALL_CELLS = 20_000
EVERY = "every document"
X = [f"x{i}" for i in range(len(LEAST_SPREAD))]


def statistics(docs: DataFrame) -> DataFrame:
    """`docs` and n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_words", words(F.col("text"))).withColumn("_lines", lines)
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": _windows(F.col("_words")),
        }
    )
    repeats = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeated(F.col("_windows"))
    ).otherwise(F.lit(0))
    return out.withColumn("n_repeat_words", repeats.cast("long")).drop(
        "_words", "_lines", "_windows"
    )


def _windows(found: Column) -> Column:
    """A hash of every 8-word window, by first word."""
    last = F.size(found) - REPEAT_WINDOW
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(found, i, REPEAT_WINDOW))
        ),
    ).otherwise(F.array().cast("array<long>"))


def _repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more."""
    placed = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )

    def twins(order: Column) -> Column:
        found = F.transform(
            order,
            lambda x, k: F.when(
                (F.get(order, k - 1)["h"] == x["h"]) | (F.get(order, k + 1)["h"] == x["h"]),
                x["i"],
            ),
        )
        return F.array_sort(F.array_compact(found))

    def covered(starts: Column) -> Column:
        new = F.transform(
            starts,
            lambda s, k: F.least(
                F.lit(REPEAT_WINDOW), s - F.coalesce(F.get(starts, k - 1), s - REPEAT_WINDOW)
            ),
        )
        return F.aggregate(new, F.lit(0), lambda total, n: total + n)

    return _let(_let(placed, twins), covered)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base_failed() -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    return (F.col("n_words") < LEAST_WORDS) | repeats


def judge(counted: DataFrame) -> DataFrame:
    """`counted`, a written table with `statistics`, and base_failed, distance, kept."""
    some = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    vector = [
        F.log1p(F.col("n_words").cast("double")),
        F.log1p(F.col("word_chars") / some),
        F.col("n_symbols") / some,
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / some,
    ]
    cell = F.to_json(F.struct("lang", "source"))
    wide = F.concat(F.lit("any source "), F.to_json(F.struct("lang")))
    rows = counted.withColumns({**dict(zip(X, vector, strict=True)), "cell": cell, "wide": wide})
    fitted = rows.where(~base_failed()).select(*X, "cell", "wide")
    sizes = fitted.groupBy("wide", "cell").agg(F.count("*").alias("n"))
    names, cells = stage_counted(_fits(sizes), "quality-cells")
    small = cells <= SMALL_CELLS
    fitted = _meet(fitted, names.select("cell", F.explode("into").alias("fit")), "cell", small)
    names = names.drop("into")

    middle = fitted.groupBy("fit").agg(
        F.count("*").alias("n"), *[F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in X]
    )
    start = middle.where(F.col("n") >= LEAST_ROWS)
    for i, spread in enumerate(LEAST_SPREAD):
        for j in range(i + 1):
            start = start.withColumn(f"l_{i}{j}", F.lit(spread if i == j else 0.0))
    estimate = stage(start.drop("n"), "quality-start")
    for step in range(STEPS):
        measured = _meet(fitted, estimate, "fit", small).select("fit", *X, _distance().alias("d"))
        bounds = measured.groupBy("fit").agg(F.percentile_approx("d", SUBSET, 1000).alias("bound"))
        inner = _meet(measured, bounds, "fit", small).where("d <= bound")
        estimate = stage(_estimate(inner), f"quality-step{step}")
    measured = _meet(fitted, estimate, "fit", small).select("fit", _distance().alias("d"))
    scales = measured.groupBy("fit").agg(F.percentile_approx("d", 0.5, 1000).alias("middle"))
    scaled = estimate.join(scales, "fit").withColumn(
        "scale", F.greatest(F.col("middle") / MEDIAN, F.lit(1.0))
    )
    final = stage(names.join(scaled, "fit", "left"), "quality-estimates")
    judged = _meet(rows, final, "cell", small, "left")
    distance = _distance() / F.col("scale")
    return judged.select(
        *counted.columns,
        base_failed().alias("base_failed"),
        distance.alias("distance"),
        (~base_failed() & (F.coalesce(distance, F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )


def _fits(sizes: DataFrame) -> DataFrame:
    """cell, fit (the estimate that judges it) and into (the estimates it takes part in)."""
    few = F.col("n") < LEAST_ROWS
    languages = sizes.groupBy("wide").agg(
        F.sum("n").alias("whole"), F.sum(F.when(few, F.col("n"))).alias("pool")
    )
    language = F.concat(F.lit("whole "), F.col("wide"))
    own = F.when(~few, F.col("cell")).when(F.col("pool") >= LEAST_ROWS, F.col("wide"))
    spread = (F.col("pool") < LEAST_ROWS) & (F.col("whole") >= LEAST_ROWS)
    rest = F.col("whole") < LEAST_ROWS
    seldom = F.broadcast(languages.agg(F.max(rest).alias("seldom")))
    into = F.array_compact(
        F.array(own, F.when(spread, language), F.when(F.col("seldom"), F.lit(EVERY)))
    )
    return sizes.join(languages, "wide").crossJoin(seldom).select(
        "cell", F.coalesce(own, F.when(rest, F.lit(EVERY)).otherwise(language)).alias("fit"),
        into.alias("into"),
    )


def _meet(rows: DataFrame, few: DataFrame, key: str, small: bool, how: str = "inner") -> DataFrame:
    """Join with a table of one row per cell, sent to all tasks only if its count allows."""
    return rows.join(F.broadcast(few) if small else few, key, how)


def _estimate(inner: DataFrame) -> DataFrame:
    """Means and Cholesky factors of the covariances, `LEAST_SPREAD` on the diagonal."""
    size = range(len(X))
    out = inner.groupBy("fit").agg(
        *[F.avg(x).alias(f"m_{x}") for x in X],
        *[F.covar_pop(X[i], X[j]).alias(f"c_{i}{j}") for i in size for j in range(i + 1)],
    )
    for j in size:
        left = sum((F.col(f"l_{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        pivot = F.col(f"c_{j}{j}") + LEAST_SPREAD[j] ** 2 - left
        out = out.withColumn(f"l_{j}{j}", F.sqrt(F.greatest(pivot, F.lit(1e-9))))
        for i in range(j + 1, len(X)):
            left = sum((F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l_{i}{j}", (F.col(f"c_{i}{j}") - left) / F.col(f"l_{j}{j}"))
    return out.select(
        "fit",
        *[f"m_{x}" for x in X],
        *[f"l_{i}{j}" for i in size for j in range(i + 1)],
    )


def _distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution."""
    solved: list[Column] = []
    for i, x in enumerate(X):
        rest = F.col(x) - F.col(f"m_{x}")
        for j, done in enumerate(solved):
            rest = rest - F.col(f"l_{i}{j}") * done
        solved.append(rest / F.col(f"l_{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def assess(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, lang, source, the statistics, base_failed, distance and kept of every row."""
    columns = list(dict.fromkeys([*keep, "lang", "source"]))
    counted = statistics(docs.select(*dict.fromkeys([*columns, "text"])))
    if "text" not in keep:
        counted = counted.drop("text")
    return judge(stage(counted, "quality-statistics"))
