from datetime import datetime

import pytest
from conftest import line, lines_frame, rows
from pyspark.sql import functions as F

from tillspark.operators import checks, measures, security, semantic, star
from tillspark.operators.lookup import lookup
from tillspark.operators.numbering import number_rows, running_before, value_ranks
from tillspark.operators.quality import clean_lines, flag_lines, quarantined_lines
from tillspark.settings import Semantic
from tillspark.sources.staging import stage

LINES = [
    line("1", "P1", "RED MUG", 2.0, datetime(2010, 12, 1, 9), 10.0, 1, "France"),
    line("1", "P2", "BLUE MUG", 1.0, datetime(2010, 12, 1, 9), 2.5, 1, "France"),
    line("2", "P1", "RED MUG", 1.0, datetime(2011, 12, 1, 9), 10.0, 2, "Spain"),
    line("3", "P2", "BLUE MUG", 4.0, datetime(2011, 3, 31, 9), 2.5, None, "Spain"),
    line("4", "P3", None, 1.0, datetime(2011, 3, 1, 9), 0.5, 3, "Unspecified"),
    line("C5", "P1", "RED MUG", -2.0, datetime(2011, 3, 2, 9), 10.0, 1, "France"),
    line("6", "POST", "POSTAGE", 1.0, None, 5.0, 1, "Norway"),
    line("7", "P1", "RED MUG", None, datetime(2011, 3, 2, 9), 10.0, 1, None),
]
SETTINGS = Semantic(
    domestic=("France",),
    europe=("Spain", "Norway"),
    entitlements=(("f@x", "France"), ("all@x", "*"), ("odd@x", "Atlantis")),
)


@pytest.fixture(scope="module")
def model(spark):
    flagged = stage(flag_lines(lines_frame(spark, LINES)), "flagged")
    clean = clean_lines(flagged)
    return semantic.build_model(
        stage(star.fact_sales(clean), "fact"),
        stage(star.dim_product(clean), "product"),
        stage(star.dim_customer(clean), "customer"),
        quarantined_lines(flagged),
        SETTINGS,
    )


def test_unknown_members_lead_each_dimension(model):
    assert model["dim_product"].where("ProductKey = -1").first()["StockCode"] == "(non-product)"
    assert model["dim_customer"].where("CustomerKey = -1").first()["IsGuest"]
    assert rows(model["dim_country"], "CountryKey", "Country", "Region") == [
        (-1, "Unknown", "4. Unspecified"), (1, "France", "1. United Kingdom"),
        (2, "Norway", "2. Europe"), (3, "Spain", "2. Europe"),
        (4, "Unspecified", "4. Unspecified"),
    ]


def test_facts_point_at_members(model):
    sales = model["fact_sales"]
    assert sales.count() == 5 and sales.where("CustomerKey = -1").count() == 1
    rejected = {r["InvoiceNo"]: r for r in model["fact_quarantine"].collect()}
    assert [rejected[i]["QuarantineKey"] for i in ("C5", "6", "7")] == [1, 2, 3]
    assert rejected["C5"]["RejectedValue"] == -20.0
    assert rejected["6"]["ProductKey"] == -1 and rejected["6"]["Date"] is None
    assert rejected["7"]["Quantity"] is None and rejected["7"]["CountryKey"] == -1


def test_bridge_has_a_row_per_rule_broken(model):
    names = model["bridge_quarantine_rule"].join(model["dim_quality_rule"], "RuleKey")
    assert rows(names, "QuarantineKey", "RuleName") == [
        (1, "cancelled_invoice"), (1, "non_positive_quantity"), (2, "missing_invoice_key"),
        (2, "non_product_stock_code"), (3, "non_positive_quantity"),
    ]


def test_calendar_covers_whole_years(model):
    days = model["dim_date"]
    assert days.count() == 730 and days.where("IsTradingDay").count() == 4
    first = days.orderBy("Date").first()
    assert (first["DateKey"], first["Quarter"], first["DayName"], first["ISOWeek"]) == (
        20100101, "2010 Q1", "Fri", 53,
    )


def test_checks_pass_and_name_what_breaks(model):
    checks.check_model(model)
    broken = {**model, "dim_product": model["dim_product"].where("StockCode <> 'P1'")}
    with pytest.raises(checks.IntegrityError, match="fact_sales.ProductKey: 2 orphan rows"):
        checks.check_model(broken)
    doubled = {**model, "dim_country": model["dim_country"].union(model["dim_country"])}
    with pytest.raises(checks.IntegrityError, match="dim_country.CountryKey: 5"):
        checks.check_model(doubled)
    gap = {**model, "dim_date": model["dim_date"].where("DateKey <> 20110615")}
    with pytest.raises(checks.IntegrityError, match="contiguous: 1"):
        checks.check_model(gap)


@pytest.mark.parametrize(
    "price, band",
    [(0.0, "1. Under GBP 1"), (0.99, "1. Under GBP 1"), (1.0, "2. GBP 1 - 2.50"),
     (2.5, "3. GBP 2.50 - 5"), (5.0, "4. GBP 5 - 10"), (10.0, "5. GBP 10+")],
)
def test_a_lower_bound_belongs_to_its_band(spark, price, band):
    assert spark.range(1).select(semantic.price_band(F.lit(price))).first()[0] == band


def test_segments_use_average_ranks(spark):
    """Ten customers, four tied at the bottom: percentiles .25 (x4), .5, .6 ... 1."""
    revenue = [5.0] * 4 + [6.0, 7.0, 8.0, 9.0, 10.0, 11.0]
    customers = spark.createDataFrame(list(enumerate(revenue)), "customer_id long, total_revenue double")
    floors = semantic.segment_floors(customers).first()
    assert tuple(floors) == (11.0, 9.0, 6.0)


def test_measures_by_hand(model):
    total = measures.sales_by(model).first()
    assert (total["revenue"], total["orders"], total["customers"]) == (43.0, 4, 3)
    assert total["average_order_value"] == pytest.approx(43 / 4)
    guest = measures.guest_measures(model).first()
    assert guest["guest_revenue"] == 10.0 and guest["guest_share"] == pytest.approx(10 / 43)
    yoy = {r["YearMonth"]: r for r in measures.revenue_year_on_year(model).collect()}
    assert len(yoy) == 24 and yoy["2011-03"]["yoy"] is None
    assert yoy["2011-12"]["yoy"] == pytest.approx((10 - 22.5) / 22.5)
    # The prior year sold and this year did not: a fall of all of it, not a blank.
    daily = {r["Date"]: r for r in measures.revenue_three_months_daily(model).collect()}
    assert daily[datetime(2011, 3, 31)]["revenue_r3m"] == 10.5
    assert daily[datetime(2011, 2, 28)]["revenue_r3m"] == 22.5
    assert daily[datetime(2010, 6, 1)]["revenue_r3m"] is None
    months = {r["YearMonth"]: r["revenue_r3m"] for r in measures.revenue_three_months(model).collect()}
    assert (months["2011-02"], months["2011-03"], months["2011-05"]) == (22.5, 10.5, 10.5)
    to_date = {r["Date"]: r for r in measures.revenue_to_date(model).collect()}
    assert to_date[datetime(2011, 1, 1)]["revenue_ytd"] is None
    assert to_date[datetime(2011, 12, 31)]["revenue_ytd"] == 20.5
    assert to_date[datetime(2011, 3, 31)]["revenue_mtd"] == 10.5
    closed = measures.revenue_by_day(model).where("Date = '2011-03-05'").first()
    assert closed["revenue"] is None and closed["no_data_message"].startswith("No sales")


def test_slicers_filter_facts_and_keep_the_calendar(model):
    cut = measures.sliced(model, Year=[2011], Region=["2. Europe"])
    assert rows(cut["fact_sales"], "InvoiceNo") == [("2",), ("3",)]
    assert cut["dim_date"].count() == 730
    assert measures.sales_by(cut).first()["revenue"] == 20.0


def test_shares_add_up(model):
    cells = measures.revenue_share(model, "PriceBand").collect()
    assert sum(c["share_of_total"] for c in cells) == pytest.approx(1.0)
    spain = [c["share_of_country"] for c in cells if c["Country"] == "Spain"]
    assert sum(spain) == pytest.approx(1.0)


def test_rejections_per_rule_tell_zero_from_not_applicable(model):
    found = {r["RuleName"]: r for r in measures.quality_by_rule(model).collect()}
    assert found["price_outlier"]["rejected_rows"] == 0
    assert found["price_outlier"]["rule_violations"] is None
    assert found["missing_description"]["rejected_rows"] is None
    assert found["non_positive_quantity"]["rejected_rows"] == 2
    total = measures.quality_measures(model).first()
    assert (total["rejected_rows"], total["rule_violations"], total["rows_extracted"]) == (3, 5, 8)
    assert total["rejected_value"] == -15.0 and total["blocking_rules"] == 7


def test_top_share_counts_products_with_revenue(model):
    # Three products sell; a fifth of three is less than one product.
    assert measures.top_share(model).first()["top_products"] is None
    half = measures.top_share(model, 0.5).first()
    assert half["top_products"] == 1 and half["top_share"] == pytest.approx(30 / 43)


def test_users_see_their_countries_and_guests(model):
    mine = security.secure(model, "f@x")
    assert rows(mine["fact_sales"], "InvoiceNo") == [("1",), ("1",)]
    assert rows(mine["dim_customer"], "CustomerID") == [("(guest)",), ("1",)]
    assert rows(mine["fact_quarantine"], "InvoiceNo") == [("C5",)]
    assert mine["security_user_country"].count() == 1
    assert rows(mine["bridge_quarantine_rule"], "QuarantineKey") == [(1,), (1,)]
    nobody = security.secure(model, "nobody@x")
    assert nobody["bridge_quarantine_rule"].count() == 0
    assert measures.quality_measures(nobody).first()["quarantine_rate"] is None
    everything = security.secure(model, "all@x")
    assert everything["fact_sales"].count() == 5 and everything["dim_country"].count() == 5
    assert everything["fact_quarantine"].count() == 3
    for user in ("nobody@x", "odd@x"):
        hidden = security.secure(model, user)
        assert hidden["fact_sales"].count() == 0 and hidden["dim_country"].count() == 0
        assert rows(hidden["dim_customer"], "CustomerID") == [("(guest)",)]
    assert rows(model["security_user_country"], "UserEmail", "CountryKey") == [
        ("all@x", 0), ("f@x", 1), ("odd@x", -1),
    ]


def test_facts_are_the_same_when_no_dimension_is_small(spark, model):
    fact = stage(star.fact_sales(clean_lines(flag_lines(lines_frame(spark, LINES)))), "fact")
    dims = [model[d] for d in ("dim_product", "dim_customer", "dim_country")]
    assert rows(semantic.fact_sales(fact, *dims, broadcast_rows=0)) == rows(model["fact_sales"])


def test_lookup_paths_agree_on_hot_missing_and_null_keys(spark):
    data = [(i, "hot") for i in range(300)] + [(i, f"k{i}") for i in range(300, 500)]
    data += [(i, None) for i in range(500, 600)]
    left = stage(spark.createDataFrame(data, "id long, k string"), "left")
    right = spark.createDataFrame([("hot", 1), ("k300", 2), ("k499", None)], "k string, v int")
    wide = lookup(left, right, "k", ["id"])
    narrow = lookup(left, right, "k", ["id"], broadcast_rows=0, hot_slots=10)
    assert rows(narrow, "id", "k", "v") == rows(wide, "id", "k", "v")
    assert narrow.count() == 600 and narrow.where("v = 1").count() == 300


def test_numbering_is_dense_and_ordered(spark):
    frame = spark.range(1000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(50)))
    order = [F.col("v").desc(), F.col("id")]
    numbered = [tuple(r) for r in number_rows(frame, order, "n").orderBy("n").collect()]
    expected = sorted(((i, v) for _, i, v in numbered), key=lambda r: (-r[1], r[0]))
    assert [n for n, _, _ in numbered] == list(range(1, 1001))
    assert [(i, v) for _, i, v in numbered] == expected
    before = running_before(frame, [F.col("id")], F.col("v"), "b").orderBy("id").collect()
    total = 0
    for row in before:
        assert row["b"] == total
        total += row["v"]


def test_value_ranks_count_peers_and_smaller_values(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,), (1.0,), (2.0,), (None,)], "v double")
    assert rows(value_ranks(frame, "v"), "v", "peers", "below") == [(1.0, 2, 0), (2.0, 1, 2), (3.0, 1, 3)]
