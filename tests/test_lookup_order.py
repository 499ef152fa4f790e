"""Tables that are sent are met before any shuffle, so their keys take no part in it."""

from tillspark.operators.lookup import lookup_all
from tillspark.operators.semantic import REJECTED
from tillspark.sources.staging import stage


def test_sent_tables_come_first(spark):
    left = stage(spark.range(400).selectExpr("id as i", "id % 90 as big", "concat('name', id % 3) as small"), "left")
    big = stage(spark.range(80).selectExpr("id as big", "id * 2 as BigKey"), "big")
    small = stage(spark.range(2).selectExpr("concat('name', id) as small", "id as SmallKey"), "small")
    found = lookup_all(left, [(big, "big"), (small, "small")], ["i"], broadcast_rows=20)
    found = found.select("i", "BigKey", "SmallKey")
    want = left.join(big, "big", "left").join(small, "small", "left").select(*found.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The join that is outermost is the shuffled one.
    assert "_deal" in plan[plan.index("Join"):].splitlines()[0]


def test_the_model_numbers_only_what_it_reads():
    assert "description" not in REJECTED and "reasons" in REJECTED
