from itertools import combinations
from random import Random

import pytest
from conftest import rows

from tillspark.operators import basket, recommend
from tillspark.settings import Recommend

OPEN = Recommend(min_support_count=1, min_confidence=0.0, min_lift=0.0, top_n=50)


def baskets(spark, *contents):
    lines = [(f"{i:04d}", code) for i, codes in enumerate(contents) for code in codes]
    return spark.createDataFrame(lines, "invoice_no string, stock_code string")


def rule(rules, a, b):
    return rules.where(f"stock_code = '{a}' and recommended_stock_code = '{b}'").first()


def test_hand_worked_figures(spark):
    found = basket.co_purchase_rules(baskets(spark, "A", "AB", "ABC"), OPEN)
    ab = rule(found, "A", "B")
    assert ab["support"] == pytest.approx(2 / 3)
    assert ab["confidence"] == pytest.approx(2 / 3)
    assert ab["lift"] == pytest.approx(1.0)


def test_oversized_basket_counts_below_the_line_only(spark):
    capped = Recommend(min_support_count=1, min_confidence=0, min_lift=0, max_basket_size=3)
    found = basket.co_purchase_rules(baskets(spark, "A", "AB", "ABCDE"), capped)
    ab = rule(found, "A", "B")
    assert ab["confidence"] == pytest.approx(1 / 3) and ab["support"] == pytest.approx(1 / 3)
    assert rule(found, "D", "E") is None


def test_lift_of_separate_pairs(spark):
    fact = baskets(spark, *["AB"] * 20, *["CD"] * 20)
    found = basket.co_purchase_rules(fact, Recommend(min_support_count=5))
    ab = rule(found, "A", "B")
    assert (ab["confidence"], ab["support"], ab["lift"]) == (1.0, 0.5, 2.0)
    assert rule(found, "A", "C") is None


def test_repeated_lines_of_one_basket_count_once(spark):
    once = basket.co_purchase_rules(baskets(spark, "AB", "AC"), OPEN)
    twice = basket.co_purchase_rules(baskets(spark, "ABAB", "AC"), OPEN)
    assert rows(once) == rows(twice)


def test_equal_lifts_rank_by_first_basket(spark):
    found = basket.co_purchase_rules(baskets(spark, "AZ", "AB", "AC"), OPEN)
    ranked = found.where("stock_code = 'A'").orderBy("rank").collect()
    assert [r["recommended_stock_code"] for r in ranked] == ["Z", "B", "C"]


def brute_pairs(contents, cap):
    counts = {}
    for codes in contents:
        if len(set(codes)) <= cap:
            for pair in combinations(sorted(set(codes)), 2):
                counts[pair] = counts.get(pair, 0) + 1
    return counts


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_pairs_match_brute_force_on_either_path(spark, broadcast_rows):
    random = Random(7)
    contents = [
        [f"P{random.randrange(30):02d}" for _ in range(random.randrange(1, 14))] for _ in range(60)
    ]
    items = basket.basket_items(baskets(spark, *contents))
    pairs = basket.pair_counts(items, 8, broadcast_rows)
    assert {(r["a"], r["b"]): r["pair_baskets"] for r in pairs.collect()} == brute_pairs(contents, 8)
    wide = basket.co_purchase_rules(baskets(spark, *contents), OPEN)
    narrow = basket.co_purchase_rules(baskets(spark, *contents), OPEN, broadcast_rows=broadcast_rows)
    assert rows(wide) == rows(narrow)


@pytest.mark.parametrize(
    "min_count, tile, bits, broadcast_rows",
    [(1, 512, None, 200_000), (1, 3, None, 200_000), (3, 4, None, 0), (2, 512, 1, 200_000), (3, 2, 12, 0), (9, 5, 4, 9)],
)
def test_tiles_and_buckets_match_brute_force(spark, min_count, tile, bits, broadcast_rows):
    random = Random(11)
    contents = [
        [f"P{int(random.paretovariate(0.7)) % 40:02d}" for _ in range(random.randrange(1, 25))] for _ in range(70)
    ]
    items = basket.basket_items(baskets(spark, *contents))
    pairs = basket.pair_counts(
        items, None, broadcast_rows, min_count=min_count, tile=tile, filter_from=0, bucket_bits=bits,
        rows=items.count(),
    )
    expected = {k: n for k, n in brute_pairs(contents, 999).items() if n >= min_count}
    first = {}
    for at, codes in enumerate(contents):
        for pair in combinations(sorted(set(codes)), 2):
            first.setdefault(pair, f"{at:04d}")
    assert rows(pairs) == sorted(((*k, n, first[k]) for k, n in expected.items()), key=repr)


def test_a_basket_of_a_hundred_thousand_products(spark):
    """Without a size limit: no list is longer than a tile, and rare products are not paired."""
    huge = spark.range(100_000).selectExpr("'0000' as invoice_no", "concat('P', lpad(id, 6, '0')) as stock_code")
    few = spark.range(1_200).selectExpr("'0001' as invoice_no", "concat('P', lpad(id * 7, 6, '0')) as stock_code")
    some = spark.range(40).selectExpr("'0002' as invoice_no", "concat('P', lpad(id * 14, 6, '0')) as stock_code")
    items = huge.unionByName(few).unionByName(some)
    part = items.where("invoice_no <> '0000' or stock_code < 'P020000'")
    lists = basket.basket_lists(part, False, 512, 200_000, None)
    longest = "greatest(max(size(basket)), max(size(beside)))"
    assert lists.where("invoice_no = '0000'").selectExpr(longest).first()[0] < 700
    pairs = basket.pair_counts(items, None, min_count=2, filter_from=100_000)
    counted = {r[0]: r[1] for r in pairs.groupBy("pair_baskets").count().collect()}
    assert counted == {2: 1_200 * 1_199 // 2 - 40 * 39 // 2, 3: 40 * 39 // 2}


def test_no_sort_aggregate(spark):
    items = basket.basket_items(baskets(spark, "AB", "ABC", "BC"))
    plan = basket.pair_counts(items, 60, min_count=2, filter_from=0)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_empty_inputs_keep_the_columns(spark):
    fact = baskets(spark, "AB").where("false")
    products = spark.createDataFrame([], "stock_code string, description string")
    recs = recommend.recommend(fact, products)
    assert recs.count() == 0 and tuple(recs.columns) == recommend.COLUMNS
    unknown = spark.createDataFrame([("A", "UNKNOWN"), ("B", "UNKNOWN")], products.schema)
    strict = Recommend(min_support_count=10_000)
    assert recommend.recommend(baskets(spark, "AB"), unknown, strict).count() == 0


def test_hubs_take_exact_medians(spark):
    data = [(s, "H", "co_purchase", lift) for s, lift in zip("abcd", (1.0, 9.0, 2.0, 4.0))]
    data += [("a", "X", "co_purchase", 5.0), ("b", "X", "content_tfidf", None)]
    recs = spark.createDataFrame(
        data, "stock_code string, recommended_stock_code string, method string, lift double"
    )
    assert rows(recommend.hubs(recs)) == [("H", 4, 3.0), ("X", 1, 5.0)]


def test_coverage_counts_both_routes(spark):
    products = spark.createDataFrame(
        [("A", "x"), ("B", "y"), ("C", "UNKNOWN"), ("D", "z")], "stock_code string, description string"
    )
    recs = spark.createDataFrame(
        [("A", "co_purchase"), ("A", "co_purchase"), ("B", "content_tfidf")],
        "stock_code string, method string",
    )
    row = recommend.coverage(recs, products).first()
    assert (row["covered_products"], row["co_purchase_products"]) == (2, 1)
    assert (row["uncovered_products"], row["uncovered_unknown"]) == (2, 1)
    assert (row["coverage_pct"], row["co_purchase_pct"]) == (50.0, 25.0)
