"""Items of a basket lie together, baskets are counted with their sizes and paired in small tasks."""

from conftest import rows

from tillspark.operators import basket
from tillspark.settings import Recommend


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_items_of_a_basket_lie_together(spark):
    fact = spark.range(4000).selectExpr("string(id % 500) as invoice_no", "string(id % 1000 div 2) as stock_code")
    items = basket.basket_items(fact)
    assert "rangepartitioning(invoice_no" in plan(items) and "hashpartitioning" not in plan(items)
    assert rows(items) == rows(fact.distinct())


def test_baskets_are_counted_with_their_sizes(spark, monkeypatch):
    contents = {"1": "AB", "2": "ABCD", "3": "A", "4": "AB", "5": "EF"}
    items = spark.createDataFrame(
        [(i, p) for i, ps in contents.items() for p in ps], "invoice_no string, stock_code string"
    )
    settings = Recommend(min_support_count=1, max_basket_size=3)
    want = rows(basket.pair_rules(items, settings, rows=11, products=6))
    _, over, n = basket.oversized_baskets(items, 3)
    assert (over, n) == (1, 5)
    monkeypatch.setattr(basket, "FILTER_FROM", 2)
    found = basket.pair_rules(items, settings, rows=11, products=6)
    assert "count(distinct" not in found._jdf.queryExecution().analyzed().toString()
    assert rows(found) == want


def test_baskets_are_paired_in_small_tasks(spark):
    items = spark.range(900).selectExpr("string(id div 9) as invoice_no", "string(id % 11) as stock_code")
    want = rows(basket.pair_counts(items, 100))
    read = spark.range(100).select("id").coalesce(1)
    assert basket.in_small_tasks(read, 1000, 1000) is read
    assert basket.in_small_tasks(read, 5001, 1000).rdd.getNumPartitions() == 6
    assert rows(basket.pair_counts(items, 100, task_pairs=50)) == want
    assert rows(basket.pair_counts(items, None, tile=4, task_pairs=50)) == want
