"""Stored aggregates, events parsed once, and the reconciliation of a build."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from routecast.operators import feedback
from routecast.operators.reconciliation import KEPT, DoesNotAddUp, Reconciliation
from routecast.plans import aggregates, queries
from routecast.plans.semantic import OPERATIONS, PUNCTUALITY, semantic_query
from routecast.plans.warehouse import StoredParts, warehouse_for
from routecast.sources.calendar import month_key

SF = "/root/testdata/sf0.001"


def _reads(df):
    """Names of the stored tables that a query's files belong to."""
    return {f.split("/")[-3] if "month_key=" in f else f.split("/")[-2] for f in df.inputFiles()}


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


CASES = [
    (PUNCTUALITY, ["route_name"], ["on_time_rate", "avg_departure_delay", "total_delay_cost", "delayed_trip_count"], {}, True),
    (PUNCTUALITY, ["season", "origin"], ["sla_breach_rate", "cascade_rate"], {"year_quarter": ["2024-Q1", "2024-Q2"]}, True),
    (PUNCTUALITY, [], ["on_time_rate", "total_passenger_delay_impact"], {"route_name": None}, True),
    (OPERATIONS, ["month", "year"], ["total_revenue", "trip_count", "completed_revenue"], {"destination": ["FRANCE", "CHINA"]}, True),
    (PUNCTUALITY, ["departure_window"], ["on_time_rate"], {}, False),
    (PUNCTUALITY, ["is_weekday"], ["on_time_rate"], {}, False),
    (PUNCTUALITY, ["route_name"], ["on_time_rate"], {"full_date": dt.date(2024, 3, 1)}, False),
    (OPERATIONS, ["veh_type"], ["trip_count"], {}, False),
]


@pytest.mark.parametrize("model,dims,metrics,filters,stored", CASES)
def test_answers_from_aggregates_equal_the_facts(spark, wh, model, dims, metrics, filters, stored):
    got = semantic_query(model, wh, dims, metrics, filters)
    plain = warehouse_for(spark, SF, materialize=False)
    assert not plain.aggregates
    want = semantic_query(model, plain, dims, metrics, filters)
    assert got.dtypes == want.dtypes and _rows(got) == _rows(want)
    assert any(t.startswith(f"{model.name}_") for t in _reads(got)) == stored
    assert any(t.startswith("fct_") for t in _reads(got)) != stored


def test_v1_and_b7_read_the_aggregates(wh):
    for query in (queries.v1_otp_by_route, queries.NAMED_QUERIES["B7_route_performance"], queries.m3_rollup_by_season):
        assert not any(t.startswith("fct_") for t in _reads(query(wh)))
    assert any(t.startswith("fct_") for t in _reads(queries.NAMED_QUERIES["V10_risk_by_time_of_day"](wh)))


def test_days_outside_the_calendar_have_no_attributes(spark, wh):
    """The calendar holds half of a month: its other days are of no season, from the aggregate as from the fact."""
    from dataclasses import replace

    cut = wh.dim_date.filter(F.col("date_key") < F.lit(dt.date(2024, 3, 15)))
    parts = aggregates.build_all([PUNCTUALITY], {"fct_punctuality": wh.fct_punctuality}, cut)
    some = replace(wh, dim_date=cut, aggregates={k: StoredParts(df, getattr(wh, t), cut) for k, (t, df) in parts.items()})
    none = replace(wh, dim_date=cut)  # the stored parts are of another calendar
    assert aggregates.answers(PUNCTUALITY, some, "punctuality", [], {}) and not aggregates.answers(PUNCTUALITY, none, "punctuality", [], {})
    args = (["season", "route_name"], ["on_time_rate", "delayed_trip_count"])
    assert _rows(semantic_query(PUNCTUALITY, some, *args)) == _rows(semantic_query(PUNCTUALITY, none, *args))
    assert None in {r.season for r in semantic_query(PUNCTUALITY, some, *args).collect()}


# -- events ----------------------------------------------------------------------


def test_typed_events_and_rejects_add_up(spark):
    rows = [
        ('{"name":"AGENT_FEEDBACK"}', '{"user.name":"u1"}', '{"categories":["a","b"],"feedback_message":"wrong","positive":false}'),
        ('{"name":"AGENT_FEEDBACK"}', '{"user.name":7}', '{"categories":[],"positive":"false"}'),
        ('{"name":"OTHER"}', None, "{}"),
        ('{"name":"AGENT_FEEDBACK"}', '{"user.name":"u1"', '{"positive":true}'),
        ("", '{"user.name":"u1"}', "{x"),
        (None, None, None),
        ("[1,2]", "3", '"text"'),
    ]
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, i), *r) for i, r in enumerate(rows)], "timestamp timestamp_ntz, record string, resource_attributes string, value string")
    typed, bad = feedback.typed_events(events), feedback.rejected_events(events)
    assert typed.count() + bad.count() == events.count()
    assert {r.timestamp.minute: r.malformed for r in bad.collect()} == {3: "resource_attributes", 4: "record,value"}
    got = {r.timestamp.minute: r for r in typed.collect()}
    assert (got[0].user_name, got[0].category, got[0].feedback_message, got[0].is_positive) == ("u1", "a", "wrong", "false")
    assert (got[1].user_name, got[1].category, got[1].is_positive) == ("7", None, "false")
    assert got[5].record_name is None and got[6].record_name is None
    assert sorted(r.timestamp.minute for r in feedback.feedback_records(typed, negative_only=True).collect()) == [0, 1]
    # As the raw path has it, where that can read the payload.
    raw = {tuple(r) for r in feedback.parse_feedback(events.filter(F.minute("timestamp").isin(0, 1, 2))).collect()}
    assert {tuple(r) for r in feedback.feedback_records(typed).collect()} == raw


def test_queries_read_columns(wh):
    for query in (queries.x1_negative_feedback, queries.x2_keyword_feedback, queries.x1_all_feedback):
        df = query(wh)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parse_json" not in plan and _reads(df) == {"feedback"}


# -- reconciliation ---------------------------------------------------------------


def test_every_row_has_one_outcome(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (-3, "x"), (-4, None), (None, "x")], "n int, s string")
    read = Reconciliation()
    kept = read.watch("t", df, {"negative": F.col("n") < 0, "no text": F.col("s").isNull()})
    assert sorted((r.n is None, r.n) for r in kept.collect()) == [(False, 2), (True, None)]
    assert read.counts() == [("t", "read", 5), ("t", KEPT, 2), ("t", "negative", 2), ("t", "no text", 1)]
    assert kept.columns == df.columns


def test_a_build_that_does_not_add_up_fails(spark):
    class Wrong:
        get = {"n_read": 5, "n0": 2, "n1": 2}

    with pytest.raises(DoesNotAddUp, match="5 rows read"):
        Reconciliation({"t": (["kept", "bad"], Wrong())}).counts()


def test_build_counts_its_inputs(wh):
    counts = {(i, o): n for i, o, n in wh.reconciliation}
    assert counts["bookings", "read"] == counts["bookings", KEPT] == wh.stg_bookings.count()
    assert counts["delay_incidents", "quarantined"] == wh.quarantined_incidents.count()
    assert counts["scheduled_trips", "invalid schedule"] == wh.stg_scheduled_trips.filter("_is_invalid_schedule").count() > 0
    assert counts["trips", KEPT] == wh.fct_trips.count() < counts["trips", "read"]


def test_month_keys_of_aggregates(wh):
    got = {r.month_key for r in wh.aggregates["operations", "trips"].parts.select("month_key").distinct().collect()}
    assert got == {r.m for r in wh.fct_trips.select(month_key("date_key").alias("m")).distinct().collect()}
