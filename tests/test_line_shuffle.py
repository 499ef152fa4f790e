"""Lines are shuffled for their orders and products only; what is known is not read again."""

import pytest
from conftest import LINE_SCHEMA, line, rows

from tillspark.operators import lookup, quality
from tillspark.operators.semantic import orphan_codes
from tillspark.operators.star import dim_product


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


@pytest.mark.parametrize("different", [3, 5000])
@pytest.mark.parametrize("twice", [False, True])
def test_attributes_are_joined_without_a_shuffle_and_keep_what_repeats(spark, different, twice):
    right = spark.range(-1, 6000).selectExpr(
        "if(id = 7, null, id) as k", f"if(id % {different} = 0, null, concat('v', id % {different})) as v"
    ).where("id % 7 != 3")
    if twice:
        right = right.unionByName(right.where("k < 20"))
    left = spark.range(-5, 7000).selectExpr("if(id % 11 = 0, null, id) as at", "id as i")
    left = left.unionByName(left.where("i < 9"))
    want = rows(left.join(right, left["at"] == right["k"]).select("at", "i", "v"))
    for few in (0, 10_000):
        found = lookup.join_attributes(left, right, "at", "k", broadcast_rows=few)
        assert found.columns == ["at", "i", "v"] and rows(found) == want
        if few == 0 and different == 3 and not twice:
            assert "hashpartitioning(at" not in plan(found)
    fractions = left.selectExpr("at + 0.5D as at", "i")
    assert lookup.join_attributes(fractions, right, "at", "k", broadcast_rows=0).count() == 0


def test_orphan_codes_of_accepted_lines(spark):
    kept = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "stock_code string")
    rejected = spark.createDataFrame([("A",), ("C",), ("C",), (None,)], "stock_code string")
    found = orphan_codes(kept, rejected)
    assert rows(found) == [("C",)] and "Join" not in plan(found)


@pytest.mark.parametrize("hot_slots", [1, 2000])
def test_descriptions_come_with_the_figures(spark, hot_slots):
    lines = [line("1", "A", "RED"), line("1", "A", "BLUE"), line("2", "A", "BLUE"), line(None, "A", "RED"),
             line("3", "B", None), line("3", None, "LOST"), line("4", "C", "X"), line("4", "C", "Y")]
    clean = spark.createDataFrame([(*x, at) for at, x in enumerate(lines)], LINE_SCHEMA)
    found = dim_product(clean, hot_slots)
    assert rows(found, "stock_code", "description", "n_invoices", "units_sold") == sorted(
        [("A", "BLUE", 2, 8.0), ("B", "UNKNOWN", 1, 2.0), ("C", "X", 1, 4.0), (None, "UNKNOWN", 1, 2.0)],
        key=repr,
    )
    # Lines are folded where the one shuffle by product brought them; names of hot products only are apart.
    moves = [at for at in plan(found).splitlines() if "Exchange hashpartitioning" in at]
    assert sum("_part" in at for at in moves) == 1 and not any("_key" in at for at in moves)
    names = [at for at in moves if "description" in at]
    assert len(names) == 1


def test_perhaps_copies_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(quality, "stage", lambda df, name: written.append(name) or df.localCheckpoint())
    lines = [line(str(i % 6), "A", quantity=float(i % 3)) for i in range(40)] + [line("9", "Z")]
    feed = spark.createDataFrame([(*x, at) for at, x in enumerate(lines)], LINE_SCHEMA)
    found = quality.with_first(feed, broadcast_rows=0)
    assert written == ["copies"]
    assert rows(found) == rows(quality.with_first(feed), *found.columns)
