import pytest
from conftest import line, lines_frame, rows
from pyspark.sql import functions as F

from tillspark.operators import quality
from tillspark.operators.quality import QualityGateError, Rule
from tillspark.settings import Quality


def test_each_rule_counts_once_but_missing_key(sample):
    results = quality.rule_results(quality.flag_lines(sample))
    counts = {r["check"]: r["failed_rows"] for r in results.collect()}
    assert counts.pop("missing_invoice_key") == 0
    assert set(counts.values()) == {1}
    assert [r["check"] for r in results.collect()] == [r.name for r in quality.RULES]


def test_percentages_have_three_places(sample):
    results = quality.rule_results(quality.flag_lines(sample)).collect()
    assert results[0]["failed_pct"] == 11.111


def test_split_keeps_every_line_and_the_guest(sample):
    flagged = quality.flag_lines(sample)
    clean, rejected = quality.clean_lines(flagged), quality.quarantined_lines(flagged)
    assert rows(clean, "invoice_no") == [("1",), ("2",), ("8",)]
    assert rejected.count() == 6
    assert rejected.where("reasons = ''").count() == 0
    assert clean.columns == sample.columns


def test_reasons_follow_rule_order_and_leave_flags_out(spark):
    bad = lines_frame(spark, [line("C1", "post", None, -1.0, None, None, None)])
    flagged = quality.flag_lines(bad)
    assert quality.quarantined_lines(flagged).first()["reasons"] == (
        "missing_invoice_key,cancelled_invoice,non_positive_quantity,"
        "non_positive_price,non_product_stock_code"
    )


def test_first_copy_stays_and_nulls_are_equal(spark):
    copies = lines_frame(
        spark,
        [line("1", "A", "first", ts=None), line("1", "A", "second", ts=None), line("1", "A")],
    )
    flagged = quality.flag_lines(copies)
    assert rows(flagged, "description", "duplicate_line_items") == [
        ("RED MUG", False), ("first", False), ("second", True),
    ]


def test_nulls_pass_the_rules_that_need_a_value(spark):
    unknown = lines_frame(spark, [line(None, None, "", None, None, None, None, None)])
    flagged = quality.flag_lines(unknown).first()
    assert not flagged["cancelled_invoice"] and not flagged["price_outlier"]
    assert not flagged["non_product_stock_code"]
    assert flagged["missing_description"] and flagged["non_positive_quantity"]


def test_hot_copies_take_the_shuffled_path(spark):
    """A third of the lines are copies of one; matched without a broadcast of all keys."""
    same = [line("1", "A")] * 100
    others = [line(str(i // 2), f"P{i // 2}") for i in range(20, 220)]
    feed = lines_frame(spark, same + others)
    flagged = quality.flag_lines(feed, broadcast_rows=0, hot_slots=4)
    wide = quality.flag_lines(feed)
    assert flagged.where("duplicate_line_items").count() == 99 + 100
    key = ("src_pos", "duplicate_line_items")
    assert rows(flagged, *key) == rows(wide, *key)


def test_gate_is_strict_and_carries_the_report(sample):
    flagged = quality.flag_lines(sample)
    exact = Quality(max_quarantine_rate=6 / 9)
    assert quality.enforce_gate(flagged, exact)["passed"]
    with pytest.raises(QualityGateError) as caught:
        quality.enforce_gate(flagged, Quality(max_quarantine_rate=0.01))
    assert caught.value.results.count() == 9


def test_gate_on_an_empty_feed(spark, sample):
    row = quality.gate(quality.flag_lines(sample.where("false"))).first()
    assert row["quarantine_rate"] == 0.0 and row["passed"]


def test_rules_can_be_added(sample):
    foreign = Rule("spanish", "validity", True, "test", lambda s: F.col("country") == "Spain")
    rules = (*quality.RULES, foreign)
    flagged = quality.flag_lines(sample, rules=rules)
    assert quality.clean_lines(flagged, rules).count() == 2
    assert quality.rule_results(flagged, rules).count() == 10
