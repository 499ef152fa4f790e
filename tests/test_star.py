from datetime import datetime

import pytest
from conftest import line, lines_frame, rows

from tillspark.operators import star


def test_best_description_and_modal_country_break_ties_by_order(spark):
    clean = lines_frame(
        spark,
        [
            line("1", "A", "ZEBRA"), line("2", "A", "APPLE"), line("3", "A", None),
            line("4", "B", "ONCE"), line("5", "B", "TWICE"), line("6", "B", "TWICE"),
            line("7", "C", None, country="Spain"), line("8", "C", None, country="Chad"),
        ],
    )
    assert rows(star.dim_product(clean), "stock_code", "description") == [
        ("A", "APPLE"), ("B", "TWICE"), ("C", "UNKNOWN"),
    ]
    tied = clean.where("stock_code = 'C'")
    assert star.dim_customer(tied).first()["country"] == "Chad"


def test_dimensions_are_unique_and_cover_the_fact(spark, sample):
    from tillspark.operators.quality import clean_lines, flag_lines

    tables = star.build_star(clean_lines(flag_lines(sample)))
    fact = tables["fact_sales"]
    assert "description" not in fact.columns
    for dim, key in (("dim_product", "stock_code"), ("dim_customer", "customer_id")):
        keys = tables[dim].select(key)
        assert keys.distinct().count() == keys.count()
        known = fact.where(f"{key} is not null")
        assert known.join(keys, key, "left_anti").count() == 0
    # Guests stay in the fact and out of the customers.
    assert fact.count() == 3 and tables["dim_customer"].count() == 2


def test_calendar_keeps_closed_days(spark):
    clean = lines_frame(
        spark, [line("1", "A", ts=datetime(2011, 3, 4, 9)), line("2", "A", ts=datetime(2011, 3, 7, 23))]
    )
    days = star.dim_date(clean).orderBy("date_key").collect()
    assert [d["has_sales"] for d in days] == [True, False, False, True]
    assert [d["is_weekend"] for d in days] == [False, True, True, False]
    assert days[1]["day_of_week"] == "Saturday"


def test_no_dates_is_an_error(spark):
    undated = lines_frame(spark, [line("1", "A", ts=None)])
    with pytest.raises(Exception, match="no valid timestamps"):
        star.dim_date(undated).collect()


def test_customer_without_any_country(spark):
    clean = lines_frame(spark, [line("1", "A", country=None)])
    assert star.dim_customer(clean).first()["country"] == "Unknown"
