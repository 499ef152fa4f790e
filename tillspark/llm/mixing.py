"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a shuffled order, over and over up to a set
number of epochs. A copy's virtual finish time is the words its source has sent
by then, divided by the source's target. All copies are range-sorted by that
time, and the mix is the front of that order, cut at the word budget.

A source is never ordered in one task: its shuffled order is cut into slices by
the leading hex digits of the shuffling key, and the global order into slices
by finish time. Word sums per slice give each slice its starting total, so a
task only sorts one slice. The number of slices follows from the row count. The
slices themselves are summed in parts, about as many as a part has slices.
The table of sources, one row each, is ordered in one task.

Null and empty texts have size 0 and are taken 0 times; a null source is a
source of its own, after all others; a null doc_id is shuffled like any other.
Repeated rows count each for itself. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.llm.text import words
from tillspark.sources.staging import stage, stage_counted

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
EPOCHS = 2
SLICE_ROWS = 4_000
EXACT = "decimal(38,0)"


def source_targets(
    sized: DataFrame, weights: Sequence[int], share_percent: int, epochs: int
) -> DataFrame:
    """source, source_size, target: shares by weight, each at most `epochs` times its size.

    A source is filled to its limit if giving every source its limit's worth per
    weight unit stays within the budget; the others share the rest by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    sources = sources.select(
        "source",
        "source_size",
        F.element_at(cycle, place.cast("int")).cast(EXACT).alias("weight"),
        (F.col("source_size") * epochs).cast(EXACT).alias("most"),
    )
    by_fill = Window.orderBy(
        F.col("most").cast("double") / F.col("weight").cast("double"),
        F.col("source").asc_nulls_last(),
    )
    whole = Window.partitionBy()
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sources = sources.select(
        "*",
        F.coalesce(F.sum("most").over(before), F.lit(0)).cast(EXACT).alias("filled"),
        F.sum("weight").over(after).cast(EXACT).alias("open_weight"),
        F.sum("source_size").over(whole).cast(EXACT).alias("total"),
    )
    spent = F.col("filled") * F.col("weight") + F.col("most") * F.col("open_weight")
    budget = F.col("total") * F.col("weight") * share_percent
    sources = sources.withColumn("full", spent * 100 <= budget)
    closed = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(whole), F.lit(0))
    unfilled = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    rest = F.col("total").cast("double") * (share_percent / 100) - closed.cast("double")
    level = rest / unfilled.cast("double")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        F.col("weight").cast("double") * level
    )
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    epochs: int = EPOCHS,
    slice_rows: int = SLICE_ROWS,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """`keep`, size, source_size, target, taken of every row of `docs`.

    taken: words of the row in the mix, repeats counted. The copy that crosses
    the budget is taken in part.
    """
    rows, count = stage_counted(
        docs.select(
            *[F.col(name).alias(f"k_{name}") for name in keep],
            F.col("source"),
            F.col("doc_id"),
            F.size(words(F.col("text"))).cast("long").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("draw"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    # What is kept of the rows stays out of the sorting and is joined to its outcome.
    sized = rows.select("row", "source", "doc_id", "size", "draw")
    digits = 0
    while 16**digits * slice_rows < count:
        digits += 1
    slices = 16**digits
    targets = stage(source_targets(sized, weights, share_percent, epochs), "mix-targets")

    sized = sized.withColumn("slice", F.substring("draw", 1, digits) if digits else F.lit(""))
    sums = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    part = F.substring("slice", 1, digits // 2)
    starts = _begun(sums, ["source"], "slice", part, "slice_size", "start")
    in_slice = (
        Window.partitionBy("source", "slice")
        .orderBy("draw", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = sized.withColumn("sent", F.sum("size").over(in_slice))
    placed = _joined(placed, _joined(starts, targets, "source"), "source", "slice")
    placed = placed.withColumn("sent", F.col("sent") + F.col("start"))

    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    copies = placed.where("size > 0").select(
        "row", "source", "draw", "doc_id", "size", "sent", "source_size", "target",
        epoch.alias("epoch"),
    )
    sent = F.col("sent") + F.col("epoch") * F.col("source_size")
    copies = copies.withColumn("finish", sent.cast("double") / F.col("target"))
    copies = stage(
        copies.select(
            "row", "source", "draw", "doc_id", "size", "epoch", "finish",
            F.floor(F.col("finish") * slices).alias("band"),
        ),
        "mix-copies",
    )
    bands = copies.groupBy("band").agg(F.sum("size").alias("band_size"))
    part = F.floor(F.col("band") / 16 ** (digits - digits // 2))
    bands = _begun(bands, [], "band", part, "band_size", "begun")
    in_band = (
        Window.partitionBy("band")
        .orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "draw", "doc_id", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    budget = targets.agg(
        F.floor(F.sum(F.col("source_size").cast(EXACT)) * share_percent / 100)
        .cast("long")
        .alias("budget")
    )
    queued = copies.select("row", "size", "band", F.sum("size").over(in_band).alias("by"))
    queued = queued.join(bands, "band").join(F.broadcast(budget))  # one row
    left = F.col("budget") - (F.col("begun") + F.col("by") - F.col("size"))
    taken = queued.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.least(F.col("size"), left))).alias("taken")
    )
    outcome = placed.select("row", "source_size", "target").join(taken, "row", "left")
    return rows.join(outcome, "row").select(
        *[F.col(f"k_{name}").alias(name) for name in keep],
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
    )


def _begun(
    sums: DataFrame, group: list[str], at: str, part: Column, amount: str, out: str
) -> DataFrame:
    """`group`, `at` and `out`: the sum of `amount` over the rows of a group before each.

    `part` ascends with `at`. Parts are summed first, so that a task orders the
    parts of a group or the rows of one part.
    """
    sums = sums.withColumn("part", part)
    parts = sums.groupBy(*group, "part").agg(F.sum(amount).alias("whole"))

    def before(name: str, keys: list[str], order: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(order)
        total = F.sum(name).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total, F.lit(0))

    parts = parts.select(*group, "part", before("whole", group, "part").alias("earlier"))
    inside = sums.withColumn("inside", before(amount, [*group, "part"], at))
    begun = (F.col("earlier") + F.col("inside")).alias(out)
    return _joined(inside, parts, *group, "part").select(*group, at, begun)


def _joined(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join in which null keys meet."""
    right = right.select(*[F.col(k).alias(f"r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    return left.join(right, same).drop(*[f"r_{k}" for k in keys])
