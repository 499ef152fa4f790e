"""Row rules: flag every line in one pass, split on the blocking ones, gate the rate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.functions.numbers import half_even
from tillspark.functions.rows import literal_rows
from tillspark.operators.bitmap import bitmap_of, bits_for, bucket_of, may_hold
from tillspark.operators.lookup import BROADCAST_ROWS, HOT_SLOTS, lookup
from tillspark.settings import Quality
from tillspark.sources.staging import stage, stage_observed
from tillspark.sources.transactions import SOURCE_POSITION

LINE_KEY = ("invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts")
FIRST_POSITION = "_first_pos"
# A hash seen twice takes one of 2 to the power of so many buckets: lines without a copy that are
# let through travel three times.
SPARE = 4


class QualityGateError(ValueError):
    """Too large a share of the feed was quarantined."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


@dataclass(frozen=True)
class Rule:
    """`fails` builds a boolean column that is true where a line breaks the rule."""

    name: str
    dimension: str
    blocking: bool
    why: str
    fails: Callable[[Quality], Column]


def _known(name: str) -> Column:
    return F.coalesce(F.upper(F.col(name)), F.lit(""))


# Names, dimensions and wording are fixed values: they are published as data.
RULES: tuple[Rule, ...] = (
    Rule(
        "duplicate_line_items",
        "uniqueness",
        True,
        "Same invoice/product/qty/price/timestamp twice - double-counts revenue",
        lambda s: F.coalesce(F.col(SOURCE_POSITION) > F.col(FIRST_POSITION), F.lit(False)),
    ),
    Rule(
        "missing_invoice_key",
        "completeness",
        True,
        "Invoice, product or timestamp is null - the row cannot be modelled",
        lambda s: F.col("invoice_no").isNull()
        | F.col("stock_code").isNull()
        | F.col("invoice_ts").isNull(),
    ),
    Rule(
        "cancelled_invoice",
        "validity",
        True,
        "'C'-prefixed invoices are cancellations, not sales",
        lambda s: _known("invoice_no").startswith("C"),
    ),
    Rule(
        "non_positive_quantity",
        "validity",
        True,
        "Returns and stock adjustments",
        lambda s: F.col("quantity").isNull() | (F.col("quantity") <= 0),
    ),
    Rule(
        "non_positive_price",
        "validity",
        True,
        "Zero-price giveaways and manual corrections",
        lambda s: F.col("unit_price").isNull() | (F.col("unit_price") < s.min_unit_price),
    ),
    Rule(
        "price_outlier",
        "validity",
        True,
        "Above the configured cap - almost always an adjustment line",
        lambda s: F.coalesce(F.col("unit_price") > s.max_unit_price, F.lit(False)),
    ),
    Rule(
        "non_product_stock_code",
        "consistency",
        True,
        "POST, BANK CHARGES, M - real rows, but not sellable products",
        lambda s: _known("stock_code").isin(*[c.upper() for c in s.non_product_codes]),
    ),
    Rule(
        "missing_description",
        "completeness",
        False,
        "Degrades the recommender, not the sales facts",
        lambda s: F.col("description").isNull() | (F.length("description") == 0),
    ),
    Rule(
        "missing_customer_id",
        "completeness",
        False,
        "Guest checkout - fine for basket analysis, not for customer analytics",
        lambda s: F.col("customer_id").isNull(),
    ),
)


def first_positions(lines: DataFrame) -> DataFrame:
    """For every line key held by several of `lines`, the position of the first.

    A grouped minimum rather than a window: copies are folded where they are
    read, so one line repeated through a third of the feed costs no more than
    any other. Nulls in the key compare equal.
    """
    return (
        lines.groupBy(*LINE_KEY)
        .agg(F.min(SOURCE_POSITION).alias(FIRST_POSITION), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .select(F.struct(*LINE_KEY).alias("_line"), FIRST_POSITION)
    )


def with_first(
    lines: DataFrame, broadcast_rows: int = BROADCAST_ROWS, hot_slots: int = HOT_SLOTS
) -> DataFrame:
    """`lines` with the position of the first line of its key, null where no other has it.

    A hash of the key is counted first, which moves eight bytes a line. Lines whose hash occurs
    once have no copy; only the others are compared by the whole key. If these are few, the
    positions are sent to the lines. If not, a bitmap of the hashes seen twice is sent, lines
    it rules out stay where they are, and the rest meet their first lines by a shuffle.
    """
    hashed = lines.withColumn("_hash", F.xxhash64(*LINE_KEY))
    twice, seen = stage_observed(
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"),
        "seen_twice", lines=F.sum("_n"),
    )
    # A key with a copy takes two of the lines counted here, so this bounds the keys.
    at_most = (seen["lines"] or 0) // 2
    if at_most <= broadcast_rows:
        copies = hashed.join(F.broadcast(twice.select("_hash")), "_hash", "left_semi")
        keyed = lines.withColumn("_line", F.struct(*LINE_KEY))
        return lookup(
            keyed, first_positions(copies), "_line", [SOURCE_POSITION], broadcast_rows,
            hot_slots, at_most=at_most,
        )
    bits = bits_for(seen["rows"], SPARE)
    buckets = bitmap_of(twice.select(bucket_of(bits, "_hash").alias("bucket")), bits)
    perhaps = may_hold(buckets, bucket_of(bits, "_hash"))
    # Few lines, read several times; all lines are read once for them and once for the rest.
    copies = stage(hashed.where(perhaps).select(*lines.columns), "copies")
    copies = copies.withColumn("_line", F.struct(*LINE_KEY))
    met = lookup(
        copies, first_positions(copies), "_line", [SOURCE_POSITION], broadcast_rows, hot_slots
    )
    alone = hashed.where(~perhaps).withColumn(
        FIRST_POSITION, F.lit(None).cast(lines.schema[SOURCE_POSITION].dataType)
    )
    return met.select(*lines.columns, FIRST_POSITION).unionByName(
        alone.select(*lines.columns, FIRST_POSITION)
    )


def flag_lines(
    lines: DataFrame,
    settings: Quality = Quality(),
    rules: Sequence[Rule] = RULES,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_slots: int = HOT_SLOTS,
) -> DataFrame:
    """The lines plus one boolean column per rule, never null. `lines` should be written."""
    placed = with_first(lines, broadcast_rows, hot_slots)
    flags = [F.coalesce(r.fails(settings), F.lit(True)).alias(r.name) for r in rules]
    return placed.select(*lines.columns, *flags)


def _blocked(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(r.name) for r in rules if r.blocking])


def clean_lines(flagged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Lines that break no blocking rule, without the flags."""
    return flagged.where(~_blocked(rules)).drop(*[r.name for r in rules])


def quarantined_lines(flagged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The other lines, with the blocking rules they break, comma-joined in rule order."""
    broken = [F.when(F.col(r.name), F.lit(r.name)) for r in rules if r.blocking]
    return (
        flagged.where(_blocked(rules))
        .withColumn("reasons", F.concat_ws(",", *broken))
        .drop(*[r.name for r in rules])
    )


def flag_totals(rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """What results and gate need: all lines, quarantined lines, and lines that break each rule."""
    return {
        "rows": F.count(F.lit(1)),
        "quarantined": F.count_if(_blocked(rules)),
        **{r.name: F.count_if(F.col(r.name)) for r in rules},
    }


def count_flags(flagged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """`flag_totals` in one row, from one scan."""
    return flagged.agg(*[total.alias(name) for name, total in flag_totals(rules).items()])


def rule_results(
    flagged: DataFrame, rules: Sequence[Rule] = RULES, counts: DataFrame | None = None
) -> DataFrame:
    """One row per rule: how many lines break it, and what share.

    `counts`, as `count_flags` gives it, saves the scan where it is known.
    """
    counts = count_flags(flagged, rules) if counts is None else counts
    share = lambda n: F.coalesce(F.try_divide(n, F.col("rows")), F.lit(0.0))
    per_rule = [
        F.struct(
            F.lit(r.name).alias("check"),
            F.lit(r.dimension).alias("dimension"),
            F.lit(r.blocking).alias("blocking"),
            F.col(r.name).alias("failed_rows"),
            half_even(100.0 * share(F.col(r.name)), 3).alias("failed_pct"),
            F.lit(r.why).alias("why"),
        )
        for r in rules
    ]
    return counts.select(F.inline(F.array(*per_rule)))


def gate(
    flagged: DataFrame,
    settings: Quality = Quality(),
    rules: Sequence[Rule] = RULES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """One row: source, quarantined and loaded counts, the rate, and whether it passes."""
    counts = count_flags(flagged, rules) if counts is None else counts
    rate = F.coalesce(F.try_divide("quarantined", "rows"), F.lit(0.0))
    return counts.select(
        F.col("rows").alias("rows_source"),
        F.col("quarantined").alias("rows_quarantined"),
        (F.col("rows") - F.col("quarantined")).alias("rows_loaded"),
        rate.alias("quarantine_rate"),
        F.lit(float(settings.max_quarantine_rate)).alias("ceiling"),
        (rate <= settings.max_quarantine_rate).alias("passed"),
    )


def enforce_gate(
    flagged: DataFrame,
    settings: Quality = Quality(),
    rules: Sequence[Rule] = RULES,
    counts: DataFrame | None = None,
) -> dict:
    """The gate's row as a dict; raises, carrying the rule results, when it fails."""
    row = gate(flagged, settings, rules, counts).first().asDict()
    if not row["passed"]:
        raise QualityGateError(
            f"quarantine rate {row['quarantine_rate']:.1%} exceeds the "
            f"{row['ceiling']:.0%} ceiling",
            rule_results(flagged, rules, counts),
        )
    return row


def stage_flagged(
    lines: DataFrame, settings: Quality = Quality(), rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """Flagged lines, written, and their counts in one row, taken while they are written."""
    flagged, seen = stage_observed(
        flag_lines(lines, settings, rules), "flagged", **flag_totals(rules)
    )
    names = list(flag_totals(rules))
    counts = literal_rows(
        lines.sparkSession, [tuple(seen[n] for n in names)], ", ".join(f"`{n}` long" for n in names)
    )
    return flagged, counts
