from datetime import datetime

import pytest
from conftest import EVENT_SCHEMA, rows

from tillspark.operators import adoption
from tillspark.settings import Adoption

# Two users of two teams, active in the week of Monday 6 April 2026.
EVENTS = [
    (datetime(2026, 4, 6, 9), "u1", "Ops", "view", None),
    (datetime(2026, 4, 6, 10), "u1", "Ops", "apply", None),
    (datetime(2026, 4, 7, 9), "u1", "Ops", "feedback", 4),
    (datetime(2026, 4, 7, 10), "u2", "Web", "view", None),
    (datetime(2026, 4, 7, 11), "u2", "Web", "view", None),
    (datetime(2026, 4, 7, 12), "u2", "Web", "view", None),
]


def frame(spark, events):
    return spark.createDataFrame(events, EVENT_SCHEMA)


def settings(as_of=None, **roster):
    return Adoption(roster=roster or {"Ops": 1, "Web": 4}, analysis_as_of=as_of)


def headline(spark, events, chosen):
    return {r["metric"]: r for r in adoption.adoption_headline(frame(spark, events), chosen).collect()}


def teams(spark, events, chosen):
    return {r["team"]: r for r in adoption.adoption_by_team(frame(spark, events), chosen).collect()}


def test_roster_is_the_denominator(spark):
    found = teams(spark, EVENTS, settings())
    assert found["Ops"]["reach_pct"] == 100.0 and found["Web"]["reach_pct"] == 25.0
    top = headline(spark, EVENTS, settings())
    assert top["reach_pct"]["value"] == 40.0 and top["activation_pct"]["value"] == 20.0
    assert top["action_rate_pct"]["value"] == 25.0 and top["csat"]["value"] == 4.0
    assert [top[m]["status"] for m in ("reach_pct", "activation_pct", "action_rate_pct", "csat")] == [
        "below target", "no target", "on track", "on track",
    ]


@pytest.mark.parametrize("as_of, reach", [("2026-08-01", 0.0), ("2026-04-07", 40.0), (None, 40.0)])
def test_window_is_measured_back_from_the_analysis_date(spark, as_of, reach):
    assert headline(spark, EVENTS, settings(as_of))["reach_pct"]["value"] == reach


def test_a_date_means_the_end_of_that_day(spark):
    moment = adoption.as_of_frame(frame(spark, EVENTS), settings("2026-04-07")).first()[0]
    assert moment == datetime(2026, 4, 7, 23, 59, 59, 999999)
    newest = adoption.as_of_frame(frame(spark, EVENTS), settings()).first()[0]
    assert newest == datetime(2026, 4, 7, 12)


def test_later_events_change_nothing(spark):
    late = [
        (datetime(2026, 5, 20, 9), "u2", "Web", "apply", None),
        (datetime(2026, 5, 20, 9), "u2", "Web", "feedback", 1),
    ]
    pinned = settings("2026-04-07")
    before = adoption.measure_adoption(frame(spark, EVENTS), pinned)
    after = adoption.measure_adoption(frame(spark, EVENTS + late), pinned)
    for name in before:
        assert rows(before[name]) == rows(after[name]), name


def test_idle_team_and_no_feedback_show(spark):
    found = teams(spark, EVENTS, settings(Ops=1, Web=4, Idle=7))
    assert found["Idle"]["reach_pct"] == 0.0 and found["Idle"]["csat"] is None
    assert found["Idle"]["action_rate_pct"] is None and found["Idle"]["csat_responses"] == 0
    silent = [e for e in EVENTS if e[3] != "feedback"]
    csat = headline(spark, silent, settings())["csat"]
    assert csat["value"] is None and csat["status"] == "no data"


def test_empty_week_keeps_its_place(spark):
    third = [(datetime(2026, 4, 20, 9), "u1", "Ops", "view", None)]
    weeks = adoption.adoption_weekly(frame(spark, EVENTS + third), settings()).orderBy("week_no").collect()
    assert [w["week_no"] for w in weeks] == [1, 2, 3]
    assert weeks[0]["week_start"] == datetime(2026, 4, 6)
    assert (weeks[1]["active_users"], weeks[1]["action_rate_pct"]) == (0, None)
    assert weeks[2]["action_rate_pct"] == 0.0
    change = adoption.reach_change(frame(spark, EVENTS + third), settings()).orderBy("week_no").collect()
    assert [c["change_pct"] for c in change] == [None, -40.0, 20.0]


def test_no_events_at_all(spark):
    none = frame(spark, [])
    found = adoption.measure_adoption(none, settings())
    assert found["adoption_weekly"].count() == 0
    assert rows(found["adoption_by_team"], "team", "reach_pct") == [("Ops", 0.0), ("Web", 0.0)]
    values = {r["metric"]: r["value"] for r in found["adoption_headline"].collect()}
    assert values == {"reach_pct": 0.0, "activation_pct": 0.0, "action_rate_pct": None, "csat": None}


def test_unlisted_team_joins_every_denominator(spark):
    events = [(datetime(2026, 4, 6, 9), f"x{i}", "New", "view", None) for i in range(20)]
    events.append((datetime(2026, 4, 6, 9), "u1", "Ops", "view", None))
    chosen = settings(Ops=1)
    assert rows(adoption.effective_roster(frame(spark, events), chosen), "team", "licensed_users") == [
        ("New", 20), ("Ops", 1),
    ]
    assert headline(spark, events, chosen)["reach_pct"]["value"] == 100.0
    assert adoption.adoption_weekly(frame(spark, events), chosen).first()["reach_pct"] == 100.0
    assert teams(spark, events, chosen)["New"]["reach_pct"] == 100.0


def test_user_of_two_teams_counts_once_overall(spark):
    events = EVENTS + [(datetime(2026, 4, 7, 13), "u1", "Web", "view", None)]
    assert headline(spark, events, settings())["reach_pct"]["value"] == 40.0
    assert teams(spark, events, settings())["Web"]["reach_pct"] == 50.0


def test_team_without_headcount_has_no_rate(spark):
    assert teams(spark, EVENTS, settings(Ops=1, Web=0))["Web"]["reach_pct"] is None
