"""Products with alike descriptions: TF-IDF weights and exact nearest neighbours.

Neighbours are found between distinct bags of terms, not between products, so a
description shared by many products is compared once. Bags meet through their
rare terms. Where a bag's common terms alone could still hide a better match, it
looks under them, from the rarest on, at the bags that a bound on the score does
not rule out. Vectors travel with candidates only, and no group of bags sharing
a common term is paired off as a whole.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.functions.text import once, tallied, terms
from tillspark.operators.lookup import BROADCAST_ROWS, HOT_SLOTS, lookup
from tillspark.operators.star import UNKNOWN_DESCRIPTION
from tillspark.settings import Recommend
from tillspark.sources.staging import (
    discard,
    release,
    stage,
    stage_counted,
    stage_observed,
)

# A term held by more bags than this is common: bags are not paired through it.
COMMON_TERM = 256
# Bags of one step of a common term that a task looks at together.
BLOCK = 512
# Steps in which a weight, or the length that is left of a vector, halves; the last one holds
# all that is smaller.
STEPS = 4
LAST_STEP = 32
# A bag without a score to beat looks at this many times `top_n` bags to get one.
SEEDS = 8
# A vector counts as so many narrow rows where a table is sent.
WIDE = 16
# Terms of documents lie in so many slices, which are worked on one after the other from so many
# terms on.
SLICES = 4
ROUND_ROWS = 2_000_000
# Steps in which the holders of a term double.
HOLDER_STEPS = 16
# A document's length is two numbers: so many times as many of them are sent as of other rows.
DOCUMENTS_SENT = 20
# How tables of terms are packed.
PACKED = "zstd"
# Similarities equal to this many places count as tied.
PLACES = 9


def _rounded(value: Column) -> Column:
    scale = F.lit(float(10**PLACES))
    return F.rint(value * scale) / scale


def term_weights(
    docs: DataFrame, key: str, found: Column, copies: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS, round_rows: int = ROUND_ROWS,
) -> DataFrame:
    """(key, term, tf, df, holders, weight): length-normalised TF-IDF of every document.

    `found` is the array of a document's terms; `copies` tells how many equal
    documents a row stands for, and `holders` how many rows hold the term. Terms
    in a single document are left out, unless that leaves no term at all.
    """
    weight = (F.col(copies) if copies else F.lit(1)).cast("long")
    # A document stays one row with its terms counted in it. They are packed hard: terms of a
    # document stand in order, so neighbours begin alike.
    held = once(tallied(F.coalesce(found, F.array().cast("array<string>"))), _slices)
    parts = [f"t{k}" for k in range(SLICES)]
    bags, seen = stage_observed(
        docs.select(key, weight.alias("_copies"), held.alias("_terms")).select(
            key, "_copies", "_terms.*"
        ),
        "terms", PACKED,
        copies=F.sum("_copies"), terms=F.sum(reduce(add, [F.size(p) for p in parts])),
    )
    n, rows = F.lit(seen["copies"] or 0), seen["terms"] or 0
    # Many terms go round by round, a slice in each, so only a round's terms lie in shuffles at
    # once.
    rounds = [[p] for p in parts] if rows > round_rows else [parts]
    met = _with_holders(bags, key, rounds, broadcast_rows)
    raw = F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
    lengths, known = stage_observed(
        met.groupBy(key).agg(
            F.sqrt(F.sum(F.pow(raw, F.lit(2.0)))).alias("_length"),
            F.count(F.lit(1)).alias("_held"),
        ),
        "lengths",
        none=F.max(F.when(F.col(key).isNull(), F.col("_length"))),
    )
    if len(rounds) > 1:
        release(docs.sparkSession)
    # Lengths are sent while they are few beside what a term costs, so terms stay where they were
    # counted and need no further shuffle to come together.
    most = broadcast_rows * DOCUMENTS_SENT
    hot = None
    if known["rows"] > most:
        hot = [r[0] for r in lengths.where(
            F.col(key).isNotNull() & (F.col("_held") > rows / HOT_SLOTS)
        ).select(key).collect()]
    whole = lookup(
        met, lengths.where(F.col(key).isNotNull()).select(key, "_length"), key, [key, "term"],
        most, at_most=known["rows"], hot_keys=hot,
    )
    length = F.when(F.col(key).isNull(), F.lit(known["none"])).otherwise(F.col("_length"))
    return whole.select(key, "term", "tf", "df", "holders", (raw / length).alias("weight"))


def _slices(held: Column) -> Column:
    """A document's counted terms, apart by slices: by their first word, as pairs of words that
    begin alike take less room together."""

    def one(k: int) -> Column:
        first = lambda x: F.xxhash64(F.substring_index(x["term"], " ", 1))
        return F.filter(held, lambda x: F.pmod(first(x), F.lit(SLICES)) == k)

    return F.struct(*[one(k).alias(f"t{k}") for k in range(SLICES)])


def _with_holders(
    bags: DataFrame, key: str, rounds: list[list[str]], broadcast_rows: int
) -> DataFrame:
    """(key, term, tf, df, holders) of the terms that count: those of two documents or more, or
    all if there are none.

    The terms with most holders are sent, and rows that hold them stay where they are; only the
    others are shuffled, to meet their counts. A term that is not sent has no more holders than
    any that is, so none of them is hot.
    """
    large = len(rounds) > 1
    free = lambda: release(bags.sparkSession) if large else None
    terms_of = lambda some: bags.select(key, "_copies", F.inline(F.concat(*some)))
    free()
    vocabulary, most, shared = [], 0, 0
    for some in rounds:
        total = Observation()
        df = terms_of(some).groupBy("term").agg(
            F.sum("_copies").alias("df"), F.count(F.lit(1)).alias("holders")
        )
        df = df.observe(total, F.max("df").alias("most")).where(F.col("df") > 1)
        df, found = stage_observed(df, "vocabulary", PACKED)
        vocabulary.append(df)
        most, shared = max(most, total.get["most"] or 0), shared + found["rows"]
        free()
    every = reduce(DataFrame.union, [terms_of(some) for some in rounds])
    if most < 2:
        alone = F.lit(1).cast("long")
        return every.select(key, "term", "tf", alone.alias("df"), alone.alias("holders"))
    counts = reduce(DataFrame.union, vocabulary)
    if shared <= broadcast_rows and not large:
        return _met(every, F.broadcast(counts), key)
    step = F.floor(F.log2("holders") * HOLDER_STEPS)
    falling = counts.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect()
    sent, cut = 0, None
    for r in falling:
        sent += r["count"]
        if sent > broadcast_rows:
            break
        cut = r["step"]
    is_common = step >= cut if cut is not None else F.lit(False)
    number = F.monotonically_increasing_id()
    common = stage(counts.where(is_common).repartition(1).withColumn("_number", number), "common")
    found = []
    for some, df in zip(rounds, vocabulary, strict=True):
        others = terms_of(some).join(F.broadcast(common.select("term")), "term", "left_anti")
        # In the order of terms they take little room.
        rare = _met(others, df.where(~is_common), key).sortWithinPartitions("term")
        found.append(stage(rare, "rare", PACKED))
        discard(df)
        free()
    # Of the documents only their common terms are left to be read, and those by their numbers.
    numbered = every.join(F.broadcast(common.select("term", "_number")), "term")
    held = stage(numbered.select(key, "_number", "tf"), "numbered", PACKED)
    discard(bags)
    found.append(held.join(F.broadcast(common), "_number").select(found[0].columns))
    return reduce(DataFrame.union, found)


def _met(terms: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    return terms.join(counts, "term").select(key, "term", "tf", "df", "holders")


def tfidf_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    return term_weights(docs, key, terms(F.col(text)))


def _catalogue(products: DataFrame, least: int) -> DataFrame:
    """Usable descriptions as bags of terms; nothing when they are too few."""
    usable = products.where(F.col("description") != UNKNOWN_DESCRIPTION)
    enough = usable.select(F.count(F.lit(1)).alias("n")).scalar() >= least
    bag = F.concat_ws("\u0001", F.array_sort(terms(F.col("description"))))
    return usable.where(enough).select("stock_code", bag.alias("bag"))


def _shared(mine: str, theirs: str) -> Column:
    """Inner product of two maps of weights; null if either is missing."""
    other = F.col(theirs)
    return F.aggregate(
        F.map_entries(mine),
        F.lit(0.0),
        lambda total, e: total
        + e["value"] * F.coalesce(F.try_element_at(other, e["key"]), F.lit(0.0)),
    )


def _top(pairs: DataFrame, top_n: int) -> DataFrame:
    best = W.partitionBy("bag").orderBy(F.col("cosine").desc(), "other_first")
    return (
        pairs.withColumn("_at", F.row_number().over(best))
        .where(F.col("_at") <= top_n)
        .select("bag", "other", "other_first", "cosine", "_at")
    )


def _through_rare_terms(
    weights: DataFrame, bags: DataFrame, common_term: int, any_common: bool, rows: int,
    broadcast_rows: int,
) -> DataFrame:
    """All pairs (wanted bag, other bag) that share a rare term, with full cosine."""
    rare = weights.where(F.col("holders") <= common_term)
    wanted = rare.join(bags.where("wanted").select("bag"), "bag", "left_semi")
    # A rare term is held by at most `common_term` bags, which bounds every group.
    met = (
        wanted.select("term", "bag", F.col("weight").alias("_w"))
        .join(rare.select("term", F.col("bag").alias("other"), "weight"), "term")
        .where(F.col("bag") != F.col("other"))
        .groupBy("bag", "other")
        .agg(F.sum(F.col("_w") * F.col("weight")).alias("rare_part"))
    )
    first = bags.select(F.col("bag").alias("other"), F.col("first_stock").alias("other_first"))
    if rows > broadcast_rows or any_common:
        met = stage(met, "met")
    both = lookup(
        met, first, "other", ["bag", "other"], broadcast_rows, at_most=rows, measured_on=met
    )
    cosine = F.col("rare_part")
    if any_common:
        tails = stage(
            weights.where(F.col("holders") > common_term)
            .groupBy("bag")
            .agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("tail")),
            "tails",
        )
        for end in ("bag", "other"):
            tail = tails.toDF(end, f"_{end}_tail")
            both = lookup(
                both, tail, end, ["bag", "other"], broadcast_rows // WIDE, at_most=rows,
                measured_on=met,
            )
        cosine = cosine + F.coalesce(_shared("_bag_tail", "_other_tail"), F.lit(0.0))
    return both.select("bag", "other", "other_first", _rounded(cosine).alias("cosine"))


def _step(value: Column) -> Column:
    """The step a weight or length falls in; `_most` gives the most it can be."""
    falls = F.floor(-F.log2(F.greatest(value, F.lit(2.0 ** (-LAST_STEP / STEPS)))) * STEPS)
    return F.greatest(falls, F.lit(0)).cast("int")


def _most(step: Column) -> Column:
    return F.pow(F.lit(2.0), -step / F.lit(STEPS))


def _postings(weights: DataFrame, common_term: int) -> DataFrame:
    """(bag, term, weight, after, slot) of every common term of a bag.

    Terms stand in one order, rarest first; `after` is the length of the bag's common part
    behind that term. `slot` is the term with the steps of both (STEPS steps halve them).
    """
    rare_first = W.partitionBy("bag").orderBy("holders", "term")
    behind = rare_first.rowsBetween(1, W.unboundedFollowing)
    square = F.col("weight") * F.col("weight")
    common = weights.where(F.col("holders") > common_term).select(
        "bag",
        "term",
        "weight",
        F.sqrt(F.coalesce(F.sum(square).over(behind), F.lit(0.0))).alias("after"),
    )
    slot = F.struct("term", _step(F.col("weight")).alias("own"), _step(F.col("after")).alias("rest"))
    return common.withColumn("slot", slot)


def _through_common_terms(
    weights: DataFrame, bags: DataFrame, best: DataFrame, top_n: int, common_term: int,
    rows: int, block: int, broadcast_rows: int,
) -> DataFrame:
    """`best` with the bags that only common terms lead to.

    Two bags whose rarest shared term is x score at most the product of their weights there
    and the product of what is left of them behind it. Postings lie in slots by the steps of
    both, so a slot has a bound for each bag that may look into it. A bag that has no `top_n`
    offers yet first looks into some of its slots, in the order of that bound, until it has
    seen enough bags: this gives it a score to beat. Then every bag looks into all slots whose
    bound reaches its score, and into no other. Inside a slot the same bound, with the true
    weights, decides which bags are compared in full.

    Both sides of a slot are dealt in parts of about `block`: its postings, and the bags that
    look into it, so a slot that very many bags open is work for many tasks.
    """
    postings = stage(_postings(weights, common_term), "postings")
    sizes = postings.groupBy("slot").agg(
        F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")
    )
    sizes, slots = stage_counted(sizes, "slots")
    part = F.pmod(F.xxhash64("bag"), F.col("parts")).cast("int")
    held = lookup(postings, sizes, "slot", ["bag"], broadcast_rows, at_most=slots)
    held = held.select(
        "slot", part.alias("part"), F.col("bag").alias("other"),
        F.col("weight").alias("_weight"), F.col("after").alias("_after"),
    )
    # A term has a row per pair of steps, whatever the number of its bags.
    steps = sizes.groupBy("slot.term").agg(
        F.collect_list(F.struct("slot", "n", "parts")).alias("steps")
    )
    vectors, _ = stage_counted(
        weights.groupBy("bag")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("v"))
        .join(bags.select("bag", "first_stock"), "bag"),
        "vectors",
    )
    wanted = postings.join(bags.where("wanted").select("bag"), "bag", "left_semi")
    slack = 2 * 10.0**-PLACES
    bound = lambda x: (
        F.col("weight") * _most(x["slot"]["own"]) + F.col("after") * _most(x["slot"]["rest"])
    )
    ask = ["bag", "weight", "after", "least"]
    for seeding in (True, False):
        last = best.where(F.col("_at") == top_n).select("bag", F.col("cosine").alias("last"))
        seeking = (
            wanted.join(last, "bag", "left")
            .withColumn("least", F.coalesce("last", F.lit(0.0)) - slack)
            .where(F.sqrt(F.pow("weight", 2) + F.pow("after", 2)) >= F.col("least"))
            .where(F.col("last").isNull() | F.lit(not seeding))
            .select(*ask, "term")
        )
        asked = lookup(seeking, steps, "term", ["bag"], broadcast_rows, at_most=slots)
        open_ = F.filter("steps", lambda x: bound(x) >= F.col("least"))
        one = lambda x: F.struct(bound(x).alias("bound"), x["slot"].alias("slot"),
                                 x["n"].alias("n"), x["parts"].alias("parts"))
        asked = asked.select(*ask, F.inline(F.transform(open_, one)))
        if seeding:
            # A bag's slots are no more than its terms have pairs of steps.
            order = W.partitionBy("bag").orderBy(F.col("bound").desc(), "slot")
            before = order.rowsBetween(W.unboundedPreceding, -1)
            asked = asked.withColumn("seen", F.coalesce(F.sum(F.least("n", F.lit(block))).over(before), F.lit(0)))
            asked = asked.where(F.col("seen") < SEEDS * top_n).withColumn("parts", F.lit(1))
        asked, opened = stage_counted(asked.select(*ask, "slot", "parts"), "seeking")
        if not opened:
            continue
        fans = asked.groupBy("slot").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("fans"))
        fans, many = stage_counted(fans.where("fans > 1"), "fans")
        fan = F.coalesce("fans", F.lit(1))
        asked = lookup(asked, fans, "slot", ["bag"], broadcast_rows, at_most=many).select(
            "bag", "weight", "after", "least", "slot",
            F.pmod(F.xxhash64("bag"), fan).cast("int").alias("fan"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        )
        spread = lookup(held, fans, "slot", ["other"], broadcast_rows, at_most=many).select(
            "slot", "part", "other", "_weight", "_after",
            F.explode(F.sequence(F.lit(0), fan - 1)).alias("fan"),
        )
        reach = F.col("weight") * F.col("_weight") + F.col("after") * F.col("_after")
        pairs = (
            asked.join(spread, ["slot", "part", "fan"])
            .where((F.col("bag") != F.col("other")) & (reach >= F.col("least")))
            .select("bag", "other")
            .distinct()
        )
        pairs = stage(pairs, "candidates")
        both = pairs
        for end in ("bag", "other"):
            side = vectors.select(
                F.col("bag").alias(end), F.col("v").alias(f"_{end}"),
                F.col("first_stock").alias(f"{end}_first"),
            )
            both = lookup(
                both, side, end, ["bag", "other"], broadcast_rows // WIDE, measured_on=pairs,
                at_most=rows,
            )
        found = both.select(
            "bag", "other", "other_first", _rounded(_shared("_bag", "_other")).alias("cosine")
        )
        scored = best.select(found.columns).unionByName(found).where(F.col("cosine") > 0)
        scored = scored.groupBy("bag", "other", "other_first").agg(F.max("cosine").alias("cosine"))
        best = stage(_top(scored, top_n), "best")
    return best


def content_similar(
    products: DataFrame,
    covered: DataFrame,
    settings: Recommend = Recommend(),
    common_term: int = COMMON_TERM,
    block: int = BLOCK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """For products not in `covered`, up to top_n others by description.

    Ordered by cosine, then stock code; products that share no term are not
    offered. `products` needs stock_code and description, `covered` stock_code.
    """
    top_n = settings.top_n
    has_rule = covered.select("stock_code").distinct().withColumn("_ruled", F.lit(True))
    known = stage(
        _catalogue(products, settings.min_catalogue)
        .join(has_rule, "stock_code", "left")
        .select("stock_code", "bag", F.col("_ruled").isNull().alias("cold")),
        "catalogue",
    )
    # One row per distinct bag. Those without a single term count as documents.
    bags, rows = stage_counted(
        known.groupBy("bag").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("stock_code").alias("first_stock"),
            F.max("cold").alias("wanted"),
        ),
        "bags",
    )
    found = F.when(F.col("bag") != "", F.split("bag", "\u0001"))
    seen = Observation()
    weights = stage(
        term_weights(bags, "bag", found, "copies", broadcast_rows).observe(
            seen, F.count_if(F.col("holders") > common_term).alias("common")
        ),
        "weights",
    )
    any_common = seen.get["common"] > 0
    met = _through_rare_terms(weights, bags, common_term, any_common, rows, broadcast_rows)
    best = _top(met.where(F.col("cosine") > 0), top_n)
    if any_common:
        best = _through_common_terms(
            weights, bags, stage(best, "best"), top_n, common_term, rows, block, broadcast_rows
        )

    # A bag's own products match it fully, if any of its terms carries weight.
    own = weights.select("bag").distinct().join(bags.where("wanted").select("bag"), "bag", "left_semi")
    chosen = best.select("bag", "other", "cosine").unionByName(
        own.select("bag", F.col("bag").alias("other"), F.lit(1.0).alias("cosine"))
    )
    place = W.partitionBy("bag").orderBy("stock_code")
    members = (
        known.withColumn("_at", F.row_number().over(place))
        .where(F.col("_at") <= top_n + 1)
        .select(F.col("bag").alias("other"), F.col("stock_code").alias("offer"))
    )
    # At most top_n + 1 bags with top_n + 1 products each.
    offers = (
        chosen.join(members, "other")
        .groupBy("bag")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("c"), "offer"))).alias("o"))
        .select("bag", F.col("o.offer").alias("offers"))
    )
    cold = known.where("cold").select("stock_code", "bag")
    listed = lookup(cold, offers, "bag", ["stock_code"], broadcast_rows, at_most=rows)
    others = F.filter("offers", lambda o: o != F.col("stock_code"))
    return _as_rules(
        listed.select("stock_code", F.posexplode(F.slice(others, 1, top_n)).alias("_at", "other")).select(
            "stock_code", "other", (F.col("_at") + 1).alias("rank")
        )
    )


def _as_rules(ranked: DataFrame) -> DataFrame:
    """In the columns of a co-purchase rule; basket figures do not apply and are null."""
    return ranked.select(
        "stock_code",
        F.col("other").alias("recommended_stock_code"),
        "rank",
        F.lit("content_tfidf").alias("method"),
        F.lit(None).cast("long").alias("pair_baskets"),
        *[F.lit(None).cast("double").alias(c) for c in ("support", "confidence", "lift")],
    )
