"""Which products share baskets: pair counts, and rules ranked by lift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.operators.bitmap import bitmap_of, bits_for, bucket_of, may_hold
from tillspark.operators.lookup import BROADCAST_ROWS, lookup
from tillspark.settings import Recommend
from tillspark.sources.staging import stage, stage_counted, stage_observed

# An oversized basket's lines are dealt over this many keys.
BASKET_SPREAD = 64
# Items or pairs from which on rare ones are looked for before they are shuffled.
FILTER_FROM = 8_000_000
# A basket of more products is paired in parts of about this many.
TILE = 512
# Frequent products take one of 2 to the power of so many buckets of their bitmap.
SPARE = 4
# Pairs that one task makes of its baskets and folds before the shuffle, about.
TASK_PAIRS = 2_000_000


def basket_items(fact: DataFrame, product: str = "stock_code") -> DataFrame:
    """Distinct (invoice_no, stock_code): a product counts once per basket.

    In ranges of both, so items of a basket lie together, though a huge one takes many ranges:
    what is counted by basket next is folded before it is shuffled. As many ranges as a shuffle
    starts with: merged by their size they would be large in memory.
    """
    ranges = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        fact.select("invoice_no", F.col(product).alias("stock_code"))
        .where(F.col("invoice_no").isNotNull() & F.col("stock_code").isNotNull())
        .repartitionByRange(ranges, "invoice_no", "stock_code")
        .distinct()
    )


def basket_stats(items: DataFrame) -> DataFrame:
    """Per product, the baskets holding it; with the number of all baskets."""
    baskets = items.select(F.count_distinct("invoice_no").alias("n")).scalar()
    return (
        items.groupBy("stock_code")
        .agg(F.count(F.lit(1)).alias("baskets"))
        .withColumn("all_baskets", baskets)
    )


def oversized_baskets(items: DataFrame, max_basket_size: int) -> tuple[DataFrame, int, int]:
    """The baskets over the limit, written; how many these are, and how many there are in all."""
    seen = Observation()
    sizes = items.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("size"))
    counted = sizes.observe(seen, F.count("invoice_no").alias("baskets"))
    over = counted.where(F.col("size") > max_basket_size).select("invoice_no")
    written, n = stage_counted(over, "oversized")
    return written, n, seen.get["baskets"]


def pairable_items(
    items: DataFrame,
    max_basket_size: int | None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows: int | None = None,
    over: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """Items of baskets no larger than the limit, if any; `rows` is their number, if known.

    `over` are the baskets over the limit and their number, if they are written. A basket over the
    limit holds more than `max_basket_size` items, so such baskets are few next to items. Repeating their ids over BASKET_SPREAD keys
    lets the lines of a huge one be struck out by many tasks.
    """
    if max_basket_size is None:
        return items
    at_most = None if rows is None else rows // (max_basket_size + 1)
    if over is not None:
        oversized, at_most = over
    elif rows is None or rows > FILTER_FROM or at_most > broadcast_rows:
        oversized, at_most, _ = oversized_baskets(items, max_basket_size)
    else:
        sizes = items.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("size"))
        oversized = sizes.where(F.col("size") > max_basket_size).select("invoice_no")
    if at_most <= broadcast_rows:
        return items.join(F.broadcast(oversized), "invoice_no", "left_anti")
    dealt = items.withColumn("_deal", F.pmod(F.xxhash64("stock_code"), F.lit(BASKET_SPREAD)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(BASKET_SPREAD - 1).cast("long"))
    struck = oversized.withColumn("_deal", F.explode(every))
    return dealt.join(struck, ["invoice_no", "_deal"], "left_anti").drop("_deal")


def basket_lists(
    items: DataFrame, whole: bool, tile: int, broadcast_rows: int, rows: int | None
) -> DataFrame:
    """(invoice_no, basket, beside, id): what is to be paired, no list longer than `tile`.

    A basket over the tile size, if any can be (`whole` is false), is cut into parts by a hash
    of the product: every part is a row, paired with itself, and every two parts are a row,
    paired with each other (`beside` is the second, null otherwise), so its items travel once
    for each part. Rows are in the order of invoice_no, and so are the ids.
    """
    if whole:
        keys = ["invoice_no"]
        listed = F.sort_array(F.collect_list("stock_code"))
        lists = items.repartitionByRange(*keys).groupBy(*keys).agg(
            listed.alias("basket"), F.lit(None).cast("array<string>").alias("beside")
        )
    else:
        sizes = items.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("_size"))
        large = sizes.where(F.col("_size") > tile).select(
            "invoice_no", F.ceil(F.col("_size") / tile).cast("int").alias("_parts")
        )
        at_most = None if rows is None else rows // (tile + 1)
        cut = lookup(items, large, "invoice_no", ["stock_code"], broadcast_rows, at_most=at_most)
        parts = F.coalesce("_parts", F.lit(1))
        part = F.pmod(F.xxhash64("stock_code"), parts).cast("int")
        other = F.explode(F.sequence(F.lit(0), parts - 1))
        met = cut.select("invoice_no", "stock_code", part.alias("part"), other.alias("other"))
        low, high = F.least("part", "other"), F.greatest("part", "other")
        keys = ["invoice_no", "low", "high"]
        met = met.withColumns({"low": low, "high": high}).repartitionByRange(*keys)
        of_part = lambda end: F.sort_array(
            F.collect_list(F.when(F.col("part") == F.col(end), F.col("stock_code")))
        )
        lists = met.groupBy(*keys).agg(of_part("low").alias("basket"), of_part("high").alias("_high"))
        lists = lists.withColumn("beside", F.when(F.col("low") < F.col("high"), F.col("_high")))
    ordered = lists.where(F.col("beside").isNotNull() | (F.size("basket") > 1))
    ordered = ordered.sortWithinPartitions("invoice_no")
    return ordered.select(
        "invoice_no", "basket", "beside", F.monotonically_increasing_id().alias("id")
    )


def _pairs(lists: DataFrame, whole: bool) -> DataFrame:
    """(id, a, b) with a < b of every pair in every list."""
    heads = lists.where(F.col("beside").isNull()).select(
        "id", "basket", F.posexplode("basket").alias("at", "a")
    )
    within = heads.select(
        "id", "a", F.explode(F.slice("basket", F.col("at") + 2, F.size("basket"))).alias("b")
    )
    if whole:
        return within
    across = lists.where(F.col("beside").isNotNull()).select("id", "beside", F.explode("basket").alias("x"))
    across = across.select("id", "x", F.explode("beside").alias("y")).select(
        "id", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    )
    return within.unionByName(across)


def in_small_tasks(lists: DataFrame, pairs: int, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """`lists` in so many parts that a task makes about `task_pairs` of the `pairs`, whatever the
    size of its files; as they are read, if these are parts enough."""
    parts = -(-pairs // task_pairs)
    return lists.repartitionByRange(parts, "id") if parts > lists.rdd.getNumPartitions() else lists


def pair_counts(
    items: DataFrame,
    max_basket_size: int | None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows: int | None = None,
    min_count: int = 1,
    tile: int = TILE,
    filter_from: int = FILTER_FROM,
    bucket_bits: int | None = None,
    per_item: DataFrame | None = None,
    over: tuple[DataFrame, int] | None = None,
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """Per unordered pair (a < b): baskets holding both, and the first of them.

    Only pairs of `min_count` baskets or more. With such a limit, products in fewer baskets are
    left out first, by a bitmap of the others, if they hold a tenth of the items; then all pairs
    are counted by buckets of their hash, and only pairs in buckets that reach the limit are
    counted by themselves, so that pairs too rare to matter are folded where they arise and never
    shuffled. Both passes read the lists from a written table. Up to `filter_from` items or pairs,
    or with so many pairs that most buckets would reach the limit, a step would cost more than
    what it saves from the shuffle. `per_item` (stock_code, n) are the baskets of each product,
    if they are written, and `over` the baskets over the limit, as `pairable_items` takes them.
    """
    kept = pairable_items(items, max_basket_size, broadcast_rows, rows, over)
    if min_count > 1 and (rows is None or rows > filter_from):
        if per_item is None:
            per_item = stage(
                items.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n")), "items"
            )
        often = F.col("n") >= min_count
        held = per_item.agg(
            F.count_if(often).alias("often"), F.sum("n").alias("items"),
            F.sum(F.when(~often, F.col("n"))).alias("rare"),
        ).first()
        if (held["rare"] or 0) * 10 >= (held["items"] or 1):
            bits = bits_for(held["often"], SPARE)
            bucket = bucket_of(bits, "stock_code")
            frequent = bitmap_of(per_item.where(often).select(bucket.alias("bucket")), bits)
            # Rare products it lets through are left out with their pairs.
            kept = kept.where(may_hold(frequent, bucket))
    whole = max_basket_size is not None and max_basket_size <= tile
    size = F.size("basket").cast("long")
    both = F.coalesce(F.size("beside").cast("long") * size, size * (size - 1) / 2)
    lists, seen = stage_observed(
        basket_lists(kept, whole, tile, broadcast_rows, rows), "baskets",
        lists=F.count(F.lit(1)), pairs=F.sum(both.cast("long")),
    )
    pairs = _pairs(in_small_tasks(lists, seen["pairs"] or 0, task_pairs), whole)
    bits = bucket_bits or bits_for(seen["pairs"] or 0)
    # Pairs a bucket gets by chance stay well below the limit.
    sparse = bucket_bits is not None or 2 * (seen["pairs"] or 0) <= (min_count - 1) << bits
    if min_count > 1 and (seen["pairs"] or 0) > filter_from and sparse:
        pairs = pairs.withColumn("bucket", bucket_of(bits, "a", "b"))
        full = pairs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        buckets = bitmap_of(full.where(F.col("n") >= min_count), bits)
        pairs = pairs.where(may_hold(buckets, F.col("bucket")))
    # The order of ids is that of invoices: a minimum of numbers needs no sort.
    counted = pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("pair_baskets"), F.min("id").alias("id")
    )
    if min_count > 1:
        counted = counted.where(F.col("pair_baskets") >= min_count)
    if seen["lists"] > broadcast_rows:
        counted = stage(counted, "pairs")
    named = lists.select("id", F.col("invoice_no").alias("first_invoice"))
    first = lookup(counted, named, "id", ["a", "b"], broadcast_rows, at_most=seen["lists"])
    return first.select("a", "b", "pair_baskets", "first_invoice")


def pair_rules(
    items: DataFrame,
    settings: Recommend = Recommend(),
    broadcast_rows: int = BROADCAST_ROWS,
    rows: int | None = None,
    products: int | None = None,
) -> DataFrame:
    """Both directions of every pair that reaches the support count, unfiltered.

    Item and basket counts cover all baskets, those of one item or over the
    size limit included; only the pair counts leave them out. `rows` and
    `products` are the numbers of items and of products, when they are known.
    """
    per_item = items.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n"))
    if products is None or products > broadcast_rows:
        per_item, products = stage_counted(per_item, "items")
    limit, over = settings.max_basket_size, None
    if limit is not None and (rows is None or rows > FILTER_FROM):
        # Baskets are counted where their sizes are.
        *over, n = oversized_baskets(items, limit)
        baskets = F.lit(n)
    else:
        baskets = items.select(F.count_distinct("invoice_no").alias("n")).scalar()
    frequent = pair_counts(
        items, limit, broadcast_rows, rows, settings.min_support_count,
        per_item=per_item if products > broadcast_rows else None, over=over,
    )
    if products > broadcast_rows:
        frequent = stage(frequent, "pairs")

    with_both = frequent
    for end in ("a", "b"):
        counts = per_item.toDF(end, f"{end}_baskets")
        with_both = lookup(
            with_both, counts, end, ["a", "b"], broadcast_rows,
            measured_on=frequent, at_most=products,
        )
    direction = lambda src, dst: F.struct(
        F.col(src).alias("stock_code"),
        F.col(dst).alias("recommended_stock_code"),
        F.col(f"{src}_baskets").alias("_src"),
        F.col(f"{dst}_baskets").alias("_dst"),
    )
    directed = with_both.select(
        "pair_baskets",
        "first_invoice",
        "a",
        "b",
        F.inline(F.array(direction("a", "b"), direction("b", "a"))),
    )
    n = baskets.cast("double")
    return directed.select(
        "stock_code",
        "recommended_stock_code",
        "pair_baskets",
        (F.col("pair_baskets") / n).alias("support"),
        (F.col("pair_baskets") / F.col("_src")).alias("confidence"),
        ((F.col("pair_baskets") / F.col("_src")) / (F.col("_dst") / n)).alias("lift"),
        "first_invoice",
        "a",
        "b",
    )


def co_purchase_rules(
    fact: DataFrame,
    settings: Recommend = Recommend(),
    product: str = "stock_code",
    broadcast_rows: int = BROADCAST_ROWS,
    products: int | None = None,
) -> DataFrame:
    """Up to top_n rules per product, by lift; equal lifts in first-basket order."""
    items, rows = stage_counted(basket_items(fact, product), "basket_items")
    kept = pair_rules(items, settings, broadcast_rows, rows, products).where(
        (F.col("confidence") >= settings.min_confidence) & (F.col("lift") >= settings.min_lift)
    )
    # Spark cuts each product to top_n before the shuffle as well as after it.
    best_first = W.partitionBy("stock_code").orderBy(
        F.col("lift").desc(), "first_invoice", "a", "b"
    )
    return (
        kept.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= settings.top_n)
        .select(
            "stock_code",
            "recommended_stock_code",
            "rank",
            F.lit("co_purchase").alias("method"),
            "pair_baskets",
            "support",
            "confidence",
            "lift",
        )
    )
