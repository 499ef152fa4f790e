"""Keys numbered in the order of whole numbers are looked up in a bitmap, without a shuffle."""

from tillspark.operators.lookup import lookup_all, ranked
from tillspark.sources.staging import stage


def _left(spark):
    left = spark.range(-5, 1500).selectExpr("if(id % 11 = 0, null, id) as k", "id as i")
    return stage(left.unionByName(spark.sql(
        "select explode(array(9223372036854775807L, -9223372036854775808L)) as k, -9L as i"
    )), "left")


def test_numbers_equal_a_join_and_no_row_moves(spark):
    left = _left(spark)
    for at, first in enumerate((-3, 0, 64, 200)):
        ids = spark.range(first, 1300).where("id % 7 != 3 and id not between 300 and 700")
        right = stage(ids.selectExpr("id as k", "row_number() over (order by id) as n"), f"right{at}")
        right = right.selectExpr("k", "cast(n as long) as n")
        found = lookup_all(left, [(right, "k")], ["i"], broadcast_rows=10)
        want = left.join(right, "k", "left").select(*found.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" not in plan and "_deal" not in plan


def test_other_numbers_still_meet_by_a_join(spark):
    left, ids = _left(spark), spark.range(1000)
    others = [
        ids.selectExpr("id as k", "id * 2 as n"),
        ids.selectExpr("id as k", "1000 - id as n"),
        ids.selectExpr("id as k", "if(id = 70, 71, if(id = 71, 70, id)) as n"),
        ids.selectExpr("id * 1000000000 as k", "id as n"),
        ids.selectExpr("id as k", "if(id = 9, null, id) as n"),
    ]
    for at, right in enumerate(others):
        right = stage(right, f"other{at}")
        assert ranked(right, "k") is None
        found = lookup_all(left, [(right, "k")], ["i"], broadcast_rows=10)
        want = left.join(right, "k", "left").select(*found.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    assert ranked(stage(ids.selectExpr("id % 500 as k", "id as n"), "twice"), "k") is None
    assert ranked(stage(ids.selectExpr("string(id) as k", "id as n"), "text"), "k") is None
