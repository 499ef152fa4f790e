from datetime import datetime
from pathlib import Path

import pytest
from conftest import EVENT_SCHEMA, rows
from pyspark.sql import functions as F

from tillspark.functions.numbers import money_sum
from tillspark.operators.fingerprint import fingerprint
from tillspark.settings import Adoption, Extract, Settings
from tillspark.sources import records, transactions, usage

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def write(folder, name, text):
    path = Path(folder) / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_renamed_and_typed(spark, folder):
    path = write(
        folder,
        "lines.csv",
        HEADER
        + "536365, 85123a ,  WHITE HOLDER ,6,12/1/2010 8:26,2.55,17850,United Kingdom\n"
        + "c536366,22423,NA,x,13/45/2010 8:26,free,1.7,France\n"
        + "536367,22424,   ,1.0,01/02/2011 18:05,1,17850.0,\n",
    )
    first, second, third = transactions.read_lines(spark, path).orderBy("src_pos").collect()
    assert first["stock_code"] == "85123A" and first["description"] == "WHITE HOLDER"
    assert first["invoice_ts"] == datetime(2010, 12, 1, 8, 26) and first["customer_id"] == 17850
    assert second["invoice_no"] == "c536366"
    assert [second[c] for c in ("description", "quantity", "invoice_ts", "unit_price")] == [None] * 4
    assert second["customer_id"] is None
    assert third["description"] == "" and third["customer_id"] == 17850
    assert third["quantity"] == 1.0 and third["country"] is None


def test_missing_columns_are_named(spark, folder):
    path = write(folder, "short.csv", "InvoiceNo,StockCode,Quantity\n1,A,2\n")
    with pytest.raises(transactions.FeedContractError, match="Country.*Description"):
        transactions.read_lines(spark, path)


def test_empty_and_undated_feeds_are_refused(spark, folder):
    empty = transactions.read_lines(spark, write(folder, "empty.csv", HEADER))
    with pytest.raises(transactions.FeedContractError, match="no rows"):
        transactions.check_lines(empty)
    undated = write(folder, "undated.csv", HEADER + "1,A,D,1,2010-12-01,1,1,France\n")
    with pytest.raises(transactions.FeedContractError, match="date_format"):
        transactions.check_lines(transactions.read_lines(spark, undated))


def test_events_off_scale_or_without_team_are_refused(spark):
    at = datetime(2026, 4, 7)
    events = lambda *r: spark.createDataFrame(list(r), EVENT_SCHEMA)
    good = (at, "u", "T", "feedback", 5)
    usage.check_events(events(good))
    with pytest.raises(usage.UsageContractError, match="outside 1-5: 9"):
        usage.check_events(events(good, (at, "u", "T", "feedback", 9)))
    with pytest.raises(usage.UsageContractError, match="1 event"):
        usage.check_events(events(good, (at, "u", "  ", "view", None)))
    # A score on another kind of event is not a feedback score.
    usage.check_events(events(good, (at, "u", "T", "view", 9)))


def test_usage_csv(spark, folder):
    path = write(
        folder, "usage.csv",
        "event_ts,user_id,team,event_type,stock_code,feedback_score\n"
        "2026-04-06 09:00:00,u1,Ops,view,A,\n2026-04-06 09:01:00,u1,Ops,feedback,,4.0\n",
    )
    assert rows(usage.read_usage(spark, path), "user_id", "event_type", "feedback_score") == [
        ("u1", "feedback", 4), ("u1", "view", None),
    ]


def test_fingerprint_ignores_order_but_not_content(spark):
    make = lambda data: spark.createDataFrame(data, "a string, b int")
    digest = lambda data: tuple(fingerprint(make(data), ["a", "b"], "x").first())
    base = digest([("x", 1), ("y", None)])
    assert digest([("y", None), ("x", 1)]) == base
    assert digest([("x", 1), ("y", 0)]) != base
    # Equal rows must not cancel out.
    assert digest([("x", 1), ("x", 1)]) != digest([("y", 1), ("y", 1)])


def test_settings_from_dict_refuse_what_they_do_not_know():
    made = Settings.from_dict({"recommend": {"top_n": 3}, "adoption": {"csat_scale": [1, 4]}})
    assert made.recommend.top_n == 3 and made.adoption.csat_scale == (1, 4)
    assert made.quality == Settings().quality and made.adoption.roster == Adoption().roster
    with pytest.raises(ValueError, match="top_m"):
        Settings.from_dict({"recommend": {"top_m": 3}})


def test_quoted_fields_and_line_breaks(spark, folder):
    row = '1,A,"12"" PLATE, RED",2,12/1/2010 8:26,1.5,7,France\n'
    found = transactions.read_lines(spark, write(folder, "q.csv", HEADER + row)).first()
    assert (found["description"], found["quantity"]) == ('12" PLATE, RED', 2.0)
    broken = '1,A,"RED\nPLATE",2,12/1/2010 8:26,1.5,7,France\n'
    lines = transactions.read_lines(
        spark, write(folder, "b.csv", HEADER + broken), Extract(multi_line=True)
    )
    assert rows(lines, "description", "country") == [("RED\nPLATE", "France")]


def test_files_that_do_not_fit_the_first_are_refused(spark, folder):
    good = HEADER + "1,A,RED,2,12/1/2010 8:26,1.5,7,France\n"
    write(folder, "a.csv", good)
    write(folder, "b.csv", HEADER.replace("Quantity,InvoiceDate,UnitPrice", "UnitPrice,Quantity,InvoiceDate")
          + "1,A,RED,1.5,2,12/1/2010 8:26,7,France\n")
    with pytest.raises(Exception, match=r"\.csv"):
        transactions.read_lines(spark, folder).collect()
    short = write(folder, "short.txt", HEADER + "1,A,RED,2\n")
    with pytest.raises(Exception, match="short.txt"):
        transactions.read_lines(spark, short).collect()


@pytest.mark.parametrize("text", ["NAN", "nan", "Infinity", "-inf", "1d", "2f", "0x1p3", "1e999"])
def test_only_finite_numbers_are_numbers(spark, text):
    spelt = spark.createDataFrame([(text,), (" -1.5e2 ",)], "v string")
    assert rows(spelt.select(transactions.number(F.col("v")).alias("n"))) == [(-150.0,), (None,)]


def test_scores_teams_and_times_are_not_bent(spark, folder):
    head = "event_ts,user_id,team,event_type,stock_code,feedback_score\n"
    for row, message in (
        ("2026-04-06 09:00:00,u1,Ops,feedback,,5.9\n", "outside 1-5: 5.9"),
        ("2026-04-06 09:00:00,u1,NA,view,,\n", "no team"),
        ("soon,u1,Ops,view,,\n", "1 event.*time"),
    ):
        read = usage.read_usage(spark, write(folder, "u.csv", head + row))
        with pytest.raises(usage.UsageContractError, match=message):
            usage.check_events(read)


def test_fingerprints_keep_fields_and_digits_apart(spark):
    make = lambda row: spark.createDataFrame([row], "a string, b string, c double")
    digests = {
        fingerprint(make(row), ["a", "b", "c"], "x").first()["digest"]
        for row in (("x|y", "z", 1.00001), ("x", "y|z", 1.00002), ("x", "y|z", 1.00003),
                    (None, "z", 1.0), ("\\N", "z", 1.0), ("-", "z", 1.0))
    }
    assert len(digests) == 6


def test_money_totals_have_room(spark):
    amounts = spark.range(20).select(F.lit(1e14).alias("v"))
    assert amounts.select(money_sum(F.col("v"))).first()[0] == 2e15


def test_unreadable_records_are_kept_with_their_file(spark, folder):
    good = "1,A,D,1,12/1/2010 8:26,1,1,France\n"
    first = write(folder, "a.csv", HEADER + good + "2,B\n" + good + "3,C,D,1,12/1/2010 8:26,1,1,France,more\n")
    second = write(folder, "b.csv", HEADER + '4,"D,1,12/1/2010 8:26,1,1,France\n' + good)
    lines, rejects = transactions.read_lines_kept(spark, folder)
    assert lines.columns == transactions.read_lines(spark, folder).columns
    assert rows(lines, "invoice_no") == [("1",)] * 3
    assert [r[0].split(",")[0] for r in rows(rejects, "record")] == ["2", "3", "4"]
    counts = {r["file"].rsplit("/", 1)[1]: r["records"] for r in records.rejected_counts(rejects).collect()}
    assert counts == {"a.csv": 2, "b.csv": 1}
    assert sorted(v for v in records.check_rejects(rejects, 0.5).values()) == [1, 2]
    with pytest.raises(records.FeedContractError, match=r"50.00% .*a.csv \(2\).*b.csv \(1\)"):
        records.check_rejects(rejects, 0.4)
    assert first != second
    clean, none = transactions.read_lines_kept(spark, write(folder + "/..", f"{Path(folder).name}.csv", HEADER + good))
    assert clean.count() == 1 and none.count() == 0 and records.check_rejects(none, 0.0) == {}


def test_unreadable_events_are_kept(spark, folder):
    head = "event_ts,user_id,team,event_type,stock_code,feedback_score\n"
    path = write(folder, "u.csv", head + "2026-04-07 10:00:00,u,T,view,,\n2026-04-07,u\n,,,,,,,\n")
    events, rejects = usage.read_usage_kept(spark, path)
    assert rows(events, "user_id", "event_type") == [("u", "view")]
    assert rows(rejects, "feed", "record") == [("usage", ",,,,,,,"), ("usage", "2026-04-07,u")]
