"""Rare products are left out by a bitmap; bitmaps are sparse enough to leave anything out."""

from collections import Counter
from itertools import combinations

from tillspark.operators import basket, quality
from tillspark.operators.bitmap import bits_for


def _baskets(rare):
    made = {str(n): {f"P{n % 7}", f"P{n % 5}", f"Q{n % 3}"} for n in range(60)}
    for n in range(rare):
        made[str(n)].add(f"R{n}")
    return made


def _pairs(spark, made):
    rows = [(k, p) for k, v in made.items() for p in v]
    items = spark.createDataFrame(rows, "invoice_no string, stock_code string")
    return basket.pair_counts(items, 60, min_count=2, filter_from=0)


def test_pairs_are_whole_with_and_without_rare_products(spark):
    for rare in (0, 5, 50):
        made = _baskets(rare)
        want = Counter(p for v in made.values() for p in combinations(sorted(v), 2))
        found = _pairs(spark, made)
        got = {(r["a"], r["b"]): r["pair_baskets"] for r in found.collect()}
        assert got == {p: n for p, n in want.items() if n > 1}


def test_a_bitmap_of_copies_lets_few_others_through():
    for values in (300, 200_000, 3_000_000):
        assert 1 << bits_for(values, quality.SPARE) >= 8 * values
