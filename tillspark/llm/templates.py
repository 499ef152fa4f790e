"""Line dedup with a log-template tree.

Lines are masked (a word with a digit becomes `<*>`) and parsed in a tree of fixed depth: by
number of words, then by leading words. In a leaf, a word stays if at least `least_docs` lines of
the leaf have it at that place; the others are variable fields and become `<*>` too. That is the
line's template, if `similarity` of its words are left, else the masked line is. So what becomes
of a line depends on counts alone: a leaf of any size gives the same templates in one task or in
many, and equal lines are one counted row before any word is counted.

A template found in at least `least_docs` different texts is dropped from all documents but the
one with the smallest doc_id, so no text leaves the corpus altogether. A masked line of
`long_words` or more is dropped from two different texts on, and lines of one or two words only
from `short_docs` on. Lines with less than `similarity` of their words unmasked stay, as tables
of numbers do. Documents with equal texts count as one: whole copies are not evidence of a
template, and are left to the operators that remove them whole.

Lines travel as hashes, words only for leaves with enough lines to hold a template. Hot leaves,
words, lines and templates are met by lookups that split them.

Null texts stay null. A document may become empty but is never dropped. Rows equal in doc_id and
text are one document; a null doc_id comes after all others. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage, stage_counted

DEPTH = 2
SIMILARITY = 0.7
LEAST_DOCS = 10
LONG_WORDS = 20
SHORT_WORDS, SHORT_DOCS = 2, 100
SENT_ROWS = 200_000
ANY = "<*>"
# White space but for the line feed, and words with a digit.
SPACES = r"[\x20\x09\x0B-\x0D]+"
NUMBERED = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _lines(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, body (hash of the text), line, masked (words joined by one space), size, leaf of
    every line with a word and `similarity` of its words unmasked.

    Lines stay strings until a leaf is known to matter: a line is masked, measured and hashed
    whole, and only lines with a digit are searched for the words that hold one. Lines are
    masked before they become rows, as a row's expressions may be computed again for each use.
    """
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACES, " ")
    plain = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    masked = F.transform(
        plain, lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, NUMBERED, ANY)).otherwise(x)
    )

    def measured(x: Column) -> Column:
        held = lambda part: F.length(x) - F.length(F.replace(x, F.lit(part)))
        hidden = F.when(x.contains(ANY), held(ANY) / len(ANY)).otherwise(0)
        return F.struct(x.alias("masked"), (held(" ") + 1).alias("size"), hidden.alias("hidden"))

    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("body"),
        F.posexplode(F.transform(masked, measured)).alias("line", "x"),
    ).select("doc_id", "body", "line", "x.*")
    rows = rows.where("masked <> ''").where(
        F.col("size") - F.col("hidden") >= F.col("size") * F.lit(similarity)
    )
    leaf = F.xxhash64("size", F.substring_index("masked", " ", DEPTH))
    return rows.drop("hidden").withColumn("leaf", leaf)


def line_templates(
    distinct: DataFrame, least_docs: int, similarity: float, sent_rows: int | None = None
) -> DataFrame:
    """mask and template (a hash) of each masked line of `distinct` (leaf, mask, tokens, n), for
    lines whose template is not the masked line itself."""
    sent_rows = SENT_ROWS if sent_rows is None else sent_rows
    places = distinct.select("leaf", "mask", "n", F.posexplode("tokens").alias("at", "word"))
    places = places.where(F.col("word") != ANY)
    held = F.struct("leaf", "at", "word")
    common = places.groupBy(held.alias("held")).agg(F.sum("n").alias("lines"))
    common = common.where(F.col("lines") >= least_docs).select("held", F.lit(True).alias("stays"))
    places = places.select("mask", held.alias("held"))
    kept = lookup(places, common, "held", ["mask"], sent_rows, measured_on=places)
    kept = kept.where("stays").groupBy("mask").agg(
        F.array_sort(F.collect_list(F.struct("held.at", "held.word"))).alias("words")
    )
    sizes = distinct.select("leaf", "mask", F.size("tokens").alias("size"))
    named = kept.join(sizes, "mask").where(F.size("words") >= F.col("size") * F.lit(similarity))
    return named.select("mask", F.xxhash64("leaf", "size", "words").alias("template"))


def recurring_lines(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    similarity: float = SIMILARITY,
    long_words: int = LONG_WORDS,
    short_docs: int = SHORT_DOCS,
    sent_rows: int | None = None,
) -> DataFrame:
    """(doc_id, body, dropped): numbers of the lines each document loses."""
    sent_rows = SENT_ROWS if sent_rows is None else sent_rows
    lines = _lines(docs, similarity)
    places = stage(
        lines.select("doc_id", "body", "line", "leaf", F.xxhash64("masked").alias("mask"), "size"),
        "template-lines",
    )
    counts = places.groupBy("leaf", "mask", "size").agg(F.count("*").alias("n"))
    counts = stage(counts.where((F.col("n") > 1) | (F.col("size") > SHORT_WORDS)), "template-counts")
    # Leaves whose lines can have a template of their own, or recur.
    leaves, many = stage_counted(
        counts.where(F.col("size") > SHORT_WORDS).groupBy("leaf")
        .agg(F.sum("n").alias("rows"), F.count("*").alias("masks"))
        .where((F.col("rows") >= least_docs) & (F.col("masks") > 1))
        .select("leaf", F.lit(True).alias("held")),
        "template-leaves",
    )
    held = lookup(
        lines, leaves, "leaf", ["doc_id", "line"], sent_rows, measured_on=places, at_most=many
    )
    distinct = (
        held.where("held")
        .groupBy("leaf", "masked")
        .agg(F.count("*").alias("n"))
        .select("leaf", "n", F.xxhash64("masked").alias("mask"), F.split("masked", " ").alias("tokens"))
    )
    distinct = stage(distinct, "template-distinct")
    templates = line_templates(distinct, least_docs, similarity, sent_rows)
    # A line recurs as its template, or as a masked line by itself.
    recurs = (F.col("n") >= least_docs) | ((F.col("n") > 1) & (F.col("size") >= long_words))
    masks = counts.select("mask", "size", recurs.alias("recurs"))
    named = masks.join(templates, "mask", "left").where("recurs or template is not null")
    alone = F.when(F.col("size") <= SHORT_WORDS, short_docs).otherwise(
        F.when(F.col("size") >= long_words, 2).otherwise(least_docs)
    )
    keys = F.array_compact(
        F.array(
            F.when(F.col("recurs"), F.struct(F.col("mask").alias("key"), alone.alias("least"))),
            F.when(
                F.col("template").isNotNull(),
                F.struct(F.col("template").alias("key"), F.lit(least_docs).alias("least")),
            ),
        )
    )
    named, masks = stage_counted(named.select("mask", keys.alias("keys")), "template-keys")
    found = lookup(
        places.select("doc_id", "body", "line", "mask"), named, "mask", ["doc_id", "line"],
        sent_rows, at_most=masks,
    )
    found = stage(
        found.where("keys is not null").select("doc_id", "body", "line", F.inline("keys")),
        "template-found",
    )
    bodies = found.groupBy("key", "least", "body").agg(F.min("doc_id").alias("first"))
    drop = (
        bodies.groupBy("key", "least")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
        .where("n >= least")
        .select("key", "first", F.lit(True).alias("goes"))
    )
    drop, recurring = stage_counted(drop, "template-recurring")
    gone = lookup(found, drop, "key", ["doc_id", "line"], sent_rows, at_most=recurring)
    return (
        gone.where("goes")
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "body")
        .agg(F.collect_set("line").alias("dropped"))
    )


def drop_templates(docs: DataFrame, **limits) -> DataFrame:
    """`docs` with recurring lines gone from `text`, and n_lines, n_dropped, which replace columns
    of those names."""
    docs = docs.drop("n_lines", "n_dropped")
    gone = recurring_lines(docs, **limits)
    gone = gone.select(*[F.col(c).alias(f"_gone_{c}") for c in ("doc_id", "body", "dropped")])
    rows = docs.withColumn("_body", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_doc_id")) & F.expr("_body = _gone_body")
    rows = rows.join(gone, same, "left")
    lines, dropped = F.split("text", "\n"), F.col("_gone_dropped")
    kept = F.filter(lines, lambda _, k: ~F.array_contains(dropped, k))
    text = F.when(dropped.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )
