"""Secret scans with corpus-wide ownership frequency.

Patterns find assignments, access keys and hex runs; these spans always stay. A
further pattern finds bare tokens of mixed characters. The value of every find
is hashed, and the distinct repositories and owners holding a hash are counted
over all documents, first per (hash, repository, owner), so that an example
copied through the whole corpus is one row per task when it is shuffled; its
counts come back to its finds by a lookup that gathers no hash in a task. A bare
token outside all pattern spans is added as a `live` span when its value belongs
to at most `max_owners` owners and does not read like a placeholder; values with
more owners are widely copied examples.

Positions come from the text between finds: the gap before each find and its own
length, summed in order. They count code points, end exclusive.

Every span, base ones too, says what its value is (`verdict`): a `copied` example, of more than
`max_owners` owners; a `placeholder` by its wording; `spread` through several repositories of
its owners; or `live`, which only one repository has.

A null text is empty and has no spans; null repositories and owners count as one
each. Repeated rows each get their spans. The result has one row per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A run of 20 or more that holds a capital, a small letter and a digit.
BARE = r"[A-Za-z0-9+/_=-]{20,}"
MIXED = r"^(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])(?=[^0-9]*[0-9])"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0000|1234|(.)\1{4}"
KINDS = ("assign", "access", "hex", "live")
ASSIGN_LEAST = 8
MAX_OWNERS = 1


def _finds(text: Column, kind: int, pattern: str, value: int) -> Column:
    """(kind, ordinal, characters since the last find, length, value) of every match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else hits
    gaps = F.split(text, pattern, -1)
    found = F.transform(
        F.arrays_zip(hits.alias("hit"), values.alias("value")),
        lambda x, k: F.struct(
            F.lit(kind).alias("kind"),
            k.alias("k"),
            F.length(F.get(gaps, k)).alias("gap"),
            F.length(x["hit"]).alias("size"),
            x["value"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), found)


def scan(
    docs: DataFrame,
    repository: Sequence[str] = ("source", "lang"),
    owner: Sequence[str] = ("source",),
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """doc_id, spans (array of start, kind, stop, value, n_owners, n_repositories, verdict) by
    start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    arrays = [
        _finds(text, 0, ASSIGN, 2),
        F.when(text.contains("AKIA"), _finds(text, 1, ACCESS, 0)),
        _finds(text, 2, HEX, 0),
        _finds(text, 3, BARE, 0),
    ]
    empty = F.array().cast("array<struct<kind:int,k:int,gap:int,size:int,value:string>>")
    rows = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64(F.to_json(F.struct(*repository))).alias("repository"),
            F.xxhash64(F.to_json(F.struct(*owner))).alias("owner"),
            F.concat(*[F.coalesce(a, empty) for a in arrays]).alias("finds"),
        ),
        "secrets-finds",
    )
    in_order = Window.partitionBy("row", "kind").orderBy("k")
    finds = rows.where(F.size("finds") > 0).select(
        "row", "repository", "owner", F.explode("finds").alias("x")
    )
    finds = finds.select("row", "repository", "owner", "x.*")
    finds = finds.withColumn(
        "stop",
        F.sum(F.col("gap") + F.col("size")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
    )
    finds = finds.withColumn("start", F.col("stop") - F.col("size"))
    mixed = F.col("value").rlike(MIXED) & ~F.col("value").rlike(PLACEHOLDER)
    finds = finds.where(
        ((F.col("kind") == 0) & (F.length("value") >= ASSIGN_LEAST))
        | F.col("kind").isin(1, 2)
        | ((F.col("kind") == 3) & mixed)
    )
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < 3
    reached = F.max(F.when(base, F.col("stop"))).over(
        by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    coming = F.min(F.when(base, F.col("start"))).over(
        by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    clear = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (
        F.coalesce(coming, F.col("stop")) >= F.col("stop")
    )
    finds = stage(
        finds.withColumns({"clear": clear, "hash": F.sha2("value", 256)}).where(
            base | F.col("clear")
        ),
        "secrets-spans",
    )
    held = finds.groupBy("hash", "repository", "owner").agg(F.count("*").alias("n"))
    owners = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    spread = owners.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories")
    )
    counted = lookup(finds, spread, "hash", ["row", "start"])
    counted = counted.where(base | (F.col("n_owners") <= max_owners))
    verdict = (
        F.when(F.col("n_owners") > max_owners, "copied")
        .when(F.col("value").rlike(PLACEHOLDER), "placeholder")
        .when(F.col("n_repositories") > 1, "spread")
        .otherwise("live")
    )
    span = F.struct(
        "start", "kind", "stop", "value", "n_owners", "n_repositories", verdict.alias("verdict")
    )
    spans = counted.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return rows.select("row", "doc_id").join(spans, "row", "left").drop("row")


def joined(spans: Column | str) -> Column:
    """kind:start:end of each, comma-joined; empty for none."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    said = F.transform(
        spans,
        lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["stop"]),
    )
    return F.coalesce(F.array_join(said, ","), F.lit(""))
