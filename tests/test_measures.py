"""Measures by bitmaps, report cuts, group columns, and all users in one plan."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import line, lines_frame, rows
from pyspark.sql import functions as F

from tillspark.operators import measures, security, semantic, star
from tillspark.operators.quality import clean_lines, flag_lines, quarantined_lines
from tillspark.settings import Semantic
from tillspark.sources.staging import stage

COUNTRIES = ("France", "Spain", "Norway", "Unspecified")


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    lines = []
    for at in range(400):
        customer = rng.choice([None, *range(1, 150)])
        # An invoice may hold lines of several countries and customers, as feeds do.
        lines.append(
            line(
                str(rng.randrange(90)), f"P{rng.randrange(130)}", rng.choice(["MUG", "CUP", None]),
                float(rng.randrange(1, 9)), datetime(2010, 11, 1) + timedelta(days=rng.randrange(500), seconds=at),
                rng.choice([0.5, 1.5, 3.0, 20.0]), customer, rng.choice(COUNTRIES),
            )
        )
    flagged = stage(flag_lines(lines_frame(spark, lines)), "flagged")
    clean = clean_lines(flagged)
    return semantic.build_model(
        stage(star.fact_sales(clean), "fact"), stage(star.dim_product(clean), "product"),
        stage(star.dim_customer(clean), "customer"), quarantined_lines(flagged),
        Semantic(domestic=("France",), europe=("Spain",)),
    )


def plain_measures(found):
    known = {r["CustomerKey"] for r in found} - {-1}
    return (
        len({r["InvoiceNo"] for r in found}), len(found), len(known), len({r["ProductKey"] for r in found}),
        sum(r["Quantity"] for r in found), round(sum(r["Revenue"] for r in found), 4),
    )


BASE = ("orders", "sales_lines", "customers", "products_sold", "units_sold", "revenue")


def test_counts_by_bitmap_are_exact(model):
    lines = measures.in_context(model, "Region", "PriceBand").collect()
    for by in ((), ("Region",), ("Region", "PriceBand")):
        expected = {}
        for r in lines:
            expected.setdefault(tuple(r[c] for c in by), []).append(r)
        found = {tuple(r[c] for c in by): tuple(r[c] for c in BASE)
                 for r in measures.sales_by(model, *by).collect()}
        assert found == {k: plain_measures(v) for k, v in expected.items()}


def test_distinct_counts_do_not_expand(model):
    plan = measures.sales_by(model, "Region")._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_no_lines_give_one_row_of_nulls_and_zeros(model):
    empty = {**model, "fact_sales": model["fact_sales"].where("false")}
    row = measures.sales_by(empty).first()
    assert (row["revenue"], row["units_sold"], row["average_order_value"]) == (None, None, None)
    assert [row[c] for c in ("orders", "sales_lines", "customers", "products_sold")] == [0, 0, 0, 0]


def test_cuts_equal_the_measures_of_each(model):
    found = rows(measures.report_cuts(model), "cut", "member", *BASE)
    expected = [("", None, *r) for r in rows(measures.sales_by(model), *BASE)]
    for cut in measures.CUTS:
        expected += [(cut, *r) for r in rows(measures.sales_by(model, cut), cut, *BASE)]
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize(
    "name, args",
    [("revenue_to_date", ()), ("revenue_year_on_year", ()), ("revenue_year_on_year_daily", ()),
     ("revenue_three_months", ()), ("revenue_three_months_daily", ()), ("revenue_by_day", ()),
     ("revenue_running_total", ("2010-12-01", "2011-02-01"))],
)
def test_time_measures_under_a_group_equal_those_of_its_part(model, name, args):
    measure = getattr(measures, name)
    grouped = measure(model, *args, "Region")
    regions = [r[0] for r in model["dim_country"].select("Region").distinct().collect()]
    wide = measures.in_context(model, "Region")
    seen = 0
    for region in regions:
        part = wide.where(F.col("Region") == region).select(*model["fact_sales"].columns)
        if part.count():
            alone = measure({**model, "fact_sales": part}, *args)
            own = grouped.where(F.col("Region") == region).drop("Region")
            assert own.columns == alone.columns
            assert rows(own) == rows(alone)
            seen += 1
    assert seen == 4 and grouped.select("Region").distinct().count() == seen


def test_all_users_equal_each_of_them(spark, model):
    rng = random.Random(1)
    granted = [(f"u{k}@x", c) for k in range(6) for c in rng.sample(COUNTRIES, rng.randrange(1, 4))]
    granted += [("all@x", "*"), ("all@x", "France"), ("odd@x", "Atlantis"), ("u0@x", granted[0][1])]
    frame = spark.createDataFrame(granted, "UserEmail string, Country string")
    model = {
        **model,
        "security_user_country": semantic.security_user_country(model["dim_country"], entitlements=frame),
    }
    found = {r["UserEmail"]: r for r in security.measures_by_user(model).collect()}
    assert set(found) == {user for user, _ in granted}
    for user, row in found.items():
        alone = measures.sales_by(security.secure(model, user)).first().asDict()
        assert {k: row[k] for k in alone} == alone, user
    again = security.measures_by_user(model, frame)
    assert rows(again, "UserEmail", *BASE) == sorted(
        ((u, *[r[c] for c in BASE]) for u, r in found.items()), key=repr
    )


def test_entitlements_from_a_table(spark, model):
    frame = spark.createDataFrame(
        [("a@x", "Spain"), ("a@x", "Spain"), ("b@x", "*"), ("c@x", "Atlantis")], "UserEmail string, Country string"
    )
    spain = model["dim_country"].where("Country = 'Spain'").first()["CountryKey"]
    table = semantic.security_user_country(model["dim_country"], entitlements=frame)
    assert rows(table, "UserEmail", "CountryKey") == [("a@x", spain), ("b@x", 0), ("c@x", -1)]
