"""Semantic API and reports: metamorphic checks against hand-written
queries, reachability errors, and the G4 period rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from routecast.plans import queries as Q
from routecast.plans.reports import months_in, revenue_at_risk, route_report
from routecast.plans.semantic import OPERATIONS, PUNCTUALITY, Between, SemanticError, calendar_bounds, semantic_query
from routecast.sources.calendar import last_full_quarter


def test_unreachable_dimension_is_rejected(wh):
    with pytest.raises(SemanticError):
        semantic_query(OPERATIONS, wh, ["channel"], ["trip_count"])
    with pytest.raises(SemanticError):
        semantic_query(OPERATIONS, wh, ["route_name"], ["no_such_metric"])


def test_multi_fact_has_no_fan_out(wh):
    both = semantic_query(OPERATIONS, wh, ["route_name"], ["trip_count", "booking_count", "total_revenue"])
    tot = both.agg(F.sum("trip_count"), F.sum("booking_count"), F.sum("total_revenue")).first()
    assert tot[0] == wh.fct_trips.count()
    assert tot[1] == wh.fct_revenue.count()
    assert tot[2] == wh.fct_revenue.agg(F.sum("total_fare")).first()[0]


def test_semantic_equals_mart_query(wh):
    """B1 (mart SQL) and the semantic metrics agree (the KPI consistency
    claim), and severities sum to all trips."""
    kpi = Q.b1_punctuality_kpis(wh).first()
    sem = semantic_query(PUNCTUALITY, wh, [], ["on_time_rate", "total_delay_cost", "sla_breach_rate"]).first()
    assert kpi.otp_rate == sem.on_time_rate
    assert kpi.total_delay_cost == sem.total_delay_cost
    assert kpi.sla_breach_rate == sem.sla_breach_rate
    assert Q.b2_severity_distribution(wh).agg(F.sum("trip_count")).first()[0] == kpi.total_trips


def test_dimension_filter_prunes(wh):
    quarters = [r.year_quarter for r in Q.m4_quarters_with_revenue(wh).collect()]
    some = sorted(quarters)[:2]
    res = Q.b7_revenue_by_quarter(wh, some).collect()
    assert sorted(r.year_quarter for r in res) == some


def test_default_period_is_last_full_quarter():
    assert last_full_quarter(dt.date(2025, 5, 17)) == (dt.date(2025, 1, 1), dt.date(2025, 4, 1))
    assert last_full_quarter(dt.date(2025, 1, 1)) == (dt.date(2024, 10, 1), dt.date(2025, 1, 1))
    assert months_in((dt.date(2024, 10, 1), dt.date(2025, 1, 1))) == 3


def test_reports_cover_every_route(wh):
    n = wh.dim_routes.count()
    rr = route_report(wh, None)
    assert rr.count() == n
    rar = revenue_at_risk(wh, None).collect()
    assert len(rar) == n
    ranks = [r.exposure_rank for r in rar]
    assert ranks == sorted(ranks) == list(range(1, n + 1))
    levels = [r.risk_level for r in rar]
    order = {"CRITICAL": 0, "HIGH": 1, "MODERATE": 2, "LOW": 3}
    assert [order[x] for x in levels] == sorted(order[x] for x in levels)


def test_to_client_refuses_unbounded_results(wh):
    from routecast.sources.sinks import to_client

    assert len(to_client(Q.v1_otp_by_route(wh), max_rows=1000)) == wh.dim_routes.count()
    with pytest.raises(ValueError):
        to_client(wh.fct_trips, max_rows=10)


def _tiny_warehouse(spark, wh):
    """Hand-written facts over the real dimensions: RT001 has trips and
    bookings, RT002 only bookings, RT003 only trips, RT999 (not in the route
    dimension -> NULL route_name) has both."""
    import datetime as dt
    from dataclasses import replace
    from decimal import Decimal

    d = dt.date(1996, 5, 1)
    trips = spark.createDataFrame(
        [("t1", "RT001", "1", d, Decimal("0.5000")), ("t2", "RT003", "1", d, Decimal("0.2500")),
         ("t3", "RT999", "1", d, Decimal("1.0000"))],
        "trip_id string, route_id string, vehicle_id string, date_key date, occupancy_rate decimal(10,4)",
    )
    rev = spark.createDataFrame(
        [("b1", "RT001", d, 2, Decimal("10.00"), "completed"), ("b2", "RT002", d, 1, Decimal("5.00"), "completed"),
         ("b3", "RT999", d, 1, Decimal("7.00"), "refunded")],
        "booking_id string, route_id string, date_key date, passengers int, total_fare decimal(18,2), booking_status string",
    )
    return replace(wh, fct_trips=trips, fct_revenue=rev)


def test_multi_fact_alignment_with_missing_members(spark, wh):
    tiny = _tiny_warehouse(spark, wh)
    res = {
        r.route_name: r
        for r in semantic_query(OPERATIONS, tiny, ["route_name"], ["trip_count", "booking_count", "total_revenue"]).collect()
    }
    names = {r.route_id: r.route_name for r in wh.dim_routes.collect()}
    assert (res[names["RT001"]].trip_count, res[names["RT001"]].booking_count) == (1, 1)
    assert (res[names["RT002"]].trip_count, res[names["RT002"]].booking_count) == (None, 1)
    assert (res[names["RT003"]].trip_count, res[names["RT003"]].booking_count) == (1, None)
    # the orphan route's rows from both facts align on the NULL member
    assert (res[None].trip_count, res[None].booking_count, str(res[None].total_revenue)) == (1, 1, "7.00")
    assert len(res) == 4


def test_row_level_facts_validation(wh):
    from routecast.plans.semantic import semantic_facts

    rows = semantic_facts(PUNCTUALITY, wh, ["departure_delay_minutes"], ["route_name"])
    assert rows.count() == wh.fct_punctuality.count()
    assert rows.columns == ["departure_delay_minutes", "route_name"]
    with pytest.raises(SemanticError):
        semantic_facts(PUNCTUALITY, wh, ["sla_threshold_minutes"])  # no fact-table fact
    with pytest.raises(SemanticError):
        semantic_facts(OPERATIONS, wh, ["passengers_onboard", "total_fare"])  # two fact tables


def test_lazy_and_materialised_warehouses_agree(spark, wh):
    """build_warehouse without a store (everything lazy) gives the same
    answers as the materialised marts."""
    from routecast.plans.warehouse import warehouse_for

    lazy = warehouse_for(spark, "/root/testdata/sf0.001", materialize=False)
    for fn in (Q.v1_otp_by_route, Q.q8_occupancy_by_route_month, Q.b8_revenue_at_risk):
        assert sorted(fn(lazy).collect()) == sorted(fn(wh).collect())
    assert sorted(lazy.fct_punctuality.collect()) == sorted(wh.fct_punctuality.collect())


DOWN, UP = True, False
ORDERS = {
    "Q2_revenue_by_route_quarter": [("total_revenue", DOWN), ("route_name", UP), ("year_quarter", UP)],
    "Q3_quarter_growth": [("revenue_growth_pct", DOWN), ("route_name", UP)],
    "Q4_occupancy_by_vehicle_type": [("avg_occupancy_pct", DOWN), ("vehicle_type", UP)],
    "Q5_revenue_per_passenger": [("revenue_per_passenger", DOWN), ("route_name", UP)],
    "Q6_underperforming_routes": [("avg_occupancy_pct", UP), ("route_name", UP), ("vehicle_type", UP)],
    "Q7_route_comparison": [("q2_revenue", DOWN), ("route_name", UP)],
    "Q8_occupancy_by_route_month": [("route_name", UP), ("month", UP)],
    "V1_otp_by_route": [("route_name", UP)],
    "V2_avg_delay_by_route": [("avg_departure_delay", DOWN), ("route_name", UP)],
    "V3_common_delay_categories": [("trip_count", DOWN), ("delay_category", UP)],
    "V8_cascading_by_route": [("cascade_rate", DOWN), ("route_name", UP)],
    "B2_severity_distribution": [("trip_count", DOWN), ("delay_severity", UP)],
    "B3_otp_heatmap": [("route_name", UP), ("month", UP)],
    "B4_category_breakdown": [("incident_trips", DOWN), ("delay_category", UP)],
    "B6_monthly_delay_trend": [("year_month", UP)],
    "B7_revenue_by_quarter": [("year_quarter", UP)],
    "B7_occupancy_by_route": [("average_occupancy_rate", DOWN), ("route_name", UP)],
    "B7_route_performance": [("total_revenue", DOWN), ("route_name", UP)],
    "B8_revenue_at_risk": [("risk_ratio_pct", DOWN), ("route_name", UP)],
    "G2_revenue_at_risk": [("exposure_rank", UP)],
    "X1_recent_feedback": [("timestamp", DOWN), ("user_name", UP), ("feedback_message", UP)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_results_come_in_order(wh, name):
    """The rows as collected are sorted, by keys that leave no ties."""
    rows = Q.NAMED_QUERIES[name](wh).collect()
    want = list(rows)
    for column, down in reversed(ORDERS[name]):
        # the source puts NULL last going up and first going down: greatest either way
        want.sort(key=lambda r: (r[column] is None, r[column] if r[column] is not None else 0), reverse=down)
    assert rows and rows == want
    keys = [tuple(r[c] for c, _ in ORDERS[name]) for r in rows]
    assert len(set(keys)) == len(keys)


def test_calendar_filters_bound_the_fact():
    d = dt.date
    assert calendar_bounds({"year": 1996}) == (d(1996, 1, 1), d(1997, 1, 1))
    assert calendar_bounds({"year_quarter": ["1996-Q2", "1995-Q4"]}) == (d(1995, 10, 1), d(1996, 7, 1))
    assert calendar_bounds({"year_quarter": "1996-Q4"}) == (d(1996, 10, 1), d(1997, 1, 1))
    assert calendar_bounds({"year": Between(1995, 1996), "full_date": d(1996, 2, 29)}) == (d(1996, 2, 29), d(1996, 3, 1))
    assert calendar_bounds({"season": "Summer", "year": Between(1995, None)}) is None
    assert calendar_bounds({"year": [1996, None]}) is None and calendar_bounds({"year": []}) is None


def test_filter_values(wh):
    def names(**filters):
        return {r.route_name for r in semantic_query(OPERATIONS, wh, ["route_name"], filters=filters).collect()}

    everything = names()
    assert names(distance_km=Between(None, 60)) | names(distance_km=Between(61, None)) == everything
    assert names(route_vehicle_type="minivan") | names(route_vehicle_type=["shuttle_bus"]) == everything
    assert names(route_vehicle_type=None) == set() and names(route_vehicle_type=["minivan", None]) == names(route_vehicle_type="minivan")
    assert names(distance_km=Between()) == everything


def test_members_of_two_tables_need_a_fact(wh):
    pairs = semantic_query(OPERATIONS, wh, ["route_name", "year_quarter"])
    assert pairs.count() == pairs.distinct().count() > 0
    # revenue alone reaches channel, trips alone reach vehicles: nothing reaches both
    with pytest.raises(SemanticError):
        semantic_query(OPERATIONS, wh, ["channel", "veh_type"])


def test_changed_input_is_built_anew(spark, tmp_path):
    import shutil

    from routecast.plans.warehouse import warehouse_for

    sf = tmp_path / "sf"
    shutil.copytree("/root/testdata/sf0.001", sf)
    for f in sf.iterdir():
        f.chmod(0o644)
    first = warehouse_for(spark, str(sf), materialize=False)
    assert warehouse_for(spark, str(sf), materialize=False) is first
    spark.read.parquet("/root/testdata/sf0.001/nation.parquet").limit(5).toPandas().to_parquet(sf / "nation.parquet")
    assert warehouse_for(spark, str(sf), materialize=False) is not first
