"""Attributes of dimensions too large to be sent travel packed, and no line is shuffled for them."""

import pytest

from tillspark.operators.lookup import lookup_attributes, packed


@pytest.mark.parametrize("different", [1, 3, 50, 300])
def test_packed_attributes_equal_a_join(spark, different):
    right = spark.range(-1, 1000).selectExpr(
        "id as k", f"if(id % {different} = 0, null, concat('v', id % {different})) as v", "id = -1 as w"
    ).where("k % 7 != 3")
    left = spark.range(-5, 1200).selectExpr("if(id % 11 = 0, null, id) as k", "id as i")
    left = left.unionByName(spark.sql("select 9223372036854775807L as k, -9L as i"))
    found = lookup_attributes(left, right, "k", ["i"], broadcast_rows=0)
    want = left.join(right, "k", "left").select(*found.columns)
    assert found.columns == ["k", "i", "v", "w"]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan.split("Subquery")[0]


def test_what_does_not_fit_is_not_packed(spark):
    ids = spark.range(6000).selectExpr("id as k", "id as v")
    assert packed(ids, "k") is None
    assert packed(ids.where("k < 10").unionByName(ids.where("k < 3")), "k") is None
    assert packed(ids.selectExpr("k * 1000000000 as k", "true as v"), "k") is None
    assert packed(ids.selectExpr("string(k) as k", "true as v"), "k") is None
    twice = ids.where("k < 10").selectExpr("k", "string(v) as v").unionByName(
        ids.where("k < 3").selectExpr("k", "'x' as v"))
    left = ids.select("k")
    found = lookup_attributes(left, twice, "k", ["k"], broadcast_rows=0)
    assert found.count() == left.join(twice, "k", "left").count()
