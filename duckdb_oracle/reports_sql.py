"""Oracle SQL of the reports (G), data-quality (D) and feedback (X) keys."""

from __future__ import annotations

#: Periods of the report keys: all years, and the last full quarter before 15 August 2024.
ALL_YEARS = ("1995-01-01", "2025-01-01", 360)
LAST_QUARTER = ("2024-04-01", "2024-07-01", 3)
SEVERITIES = ["on_time", "minor_delay", "moderate_delay", "major_delay", "severe_delay"]


def _rate(cond: str) -> str:
    return f"CAST(count_if({cond}) AS DOUBLE) / CAST(count(*) AS DOUBLE)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE)"


_TOP = """
, cat AS (
  SELECT route_id, primary_delay_category, count(*) AS trips,
    CAST(sum(departure_delay_minutes) AS DOUBLE) / CAST(count(departure_delay_minutes) AS DOUBLE) AS avg_delay
  FROM fct_punctuality WHERE {period} AND primary_delay_category IS NOT NULL GROUP BY route_id, primary_delay_category),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY trips DESC, primary_delay_category ASC) AS rk FROM cat),
top AS (
  SELECT route_id, {tops} FROM ranked WHERE rk <= {n} GROUP BY route_id)"""


def _within(period: tuple) -> str:
    return f"date_key >= DATE '{period[0]}' AND date_key < DATE '{period[1]}'"


def _top(n: int, period: tuple) -> str:
    tops = ", ".join(
        f"max(CASE WHEN rk = {i} THEN primary_delay_category END) AS top{i}_category, "
        f"max(CASE WHEN rk = {i} THEN trips END) AS top{i}_trips, "
        f"max(CASE WHEN rk = {i} THEN avg_delay END) AS top{i}_avg_delay"
        for i in range(1, n + 1)
    )
    return _TOP.format(period=_within(period), tops=tops, n=n)


def _pun(period: tuple) -> str:
    return f"""
, pun AS (
  SELECT route_id, {_rate('is_on_time')} AS on_time_rate,
    CAST(sum(departure_delay_minutes) AS DOUBLE) / CAST(count(departure_delay_minutes) AS DOUBLE) AS avg_departure_delay,
    {_rate('is_sla_breach')} AS sla_breach_rate,
    CAST(sum(estimated_delay_cost_eur) AS DECIMAL(38,2)) AS total_delay_cost,
    {_rate('has_cascading_incident')} AS cascade_rate,
    CAST(sum(total_passenger_delay_minutes) AS BIGINT) AS passenger_delay_minutes,
    CAST(count_if(delay_severity IN ('major_delay', 'severe_delay')) AS BIGINT) AS severe_trip_count,
    {', '.join(f"CAST(count_if(delay_severity = '{s}') AS BIGINT) AS {s}_trips" for s in SEVERITIES)}
  FROM fct_punctuality WHERE {_within(period)} GROUP BY route_id)"""


def g1(period: tuple) -> str:
    return (
        f"""
, trips_r AS (
  SELECT route_id, count(trip_id) AS trip_count, CAST(sum(passengers_onboard) AS BIGINT) AS total_passengers,
    sum(occupancy_rate) AS occ_sum, count(occupancy_rate) AS occ_n
  FROM fct_trips WHERE {_within(period)} GROUP BY route_id),
rev_r AS (
  SELECT route_id, CAST(sum(total_fare) AS DECIMAL(38,2)) AS total_revenue,
    CAST(sum(passengers) AS BIGINT) AS booked_passengers
  FROM fct_revenue WHERE {_within(period)} GROUP BY route_id)"""
        + _pun(period)
        + _top(3, period)
        + f"""
, j AS (
  SELECT d.route_id, d.route_name, t.trip_count, t.total_passengers, t.occ_sum, t.occ_n,
    r.total_revenue, r.booked_passengers, pun.* EXCLUDE (route_id), top.* EXCLUDE (route_id)
  FROM dim_routes d LEFT JOIN trips_r t ON d.route_id = t.route_id LEFT JOIN rev_r r ON d.route_id = r.route_id
  LEFT JOIN pun ON d.route_id = pun.route_id LEFT JOIN top ON d.route_id = top.route_id),
f AS (
  SELECT sum(occ_sum) AS s_occ, sum(occ_n) AS n_occ, sum(total_revenue) AS s_rev, sum(booked_passengers) AS s_pax,
    sum(trip_count) AS s_trips, sum(total_passengers) AS s_tp, count(trip_count) AS n_routes FROM j),
x AS (
  SELECT j.*, {_ratio('j.occ_sum', 'j.occ_n')} AS occ, {_ratio('f.s_occ', 'f.n_occ')} AS f_occ,
    {_ratio('j.total_revenue', 'j.booked_passengers')} AS rpp, {_ratio('f.s_rev', 'f.s_pax')} AS f_rpp,
    {_ratio('f.s_trips', 'f.n_routes')} AS f_trips, {_ratio('f.s_tp', 'f.n_routes')} AS f_tp
  FROM j, f)
SELECT route_id, route_name, total_revenue, rpp AS revenue_per_passenger, occ AS average_occupancy_rate,
  coalesce(trip_count, 0) AS trip_count, CAST(coalesce(total_passengers, 0) AS BIGINT) AS total_passengers,
  f_occ AS fleet_average_occupancy_rate, f_trips AS fleet_average_trip_count, f_tp AS fleet_average_passengers,
  f_rpp AS fleet_revenue_per_passenger,
  CASE WHEN occ > f_occ THEN 'above' WHEN occ < f_occ THEN 'below' WHEN occ IS NOT NULL THEN 'equal' END AS occupancy_vs_fleet,
  round((rpp - f_rpp) / nullif(f_rpp, 0) * 100.0, 1) AS revenue_per_passenger_vs_fleet_pct,
  on_time_rate, avg_departure_delay, sla_breach_rate, total_delay_cost, cascade_rate,
  {', '.join(f"coalesce({s}_trips, 0) AS {s}_trips" for s in SEVERITIES)},
  {', '.join(f"top{i}_category, top{i}_trips, top{i}_avg_delay" for i in range(1, 4))},
  coalesce(on_time_rate < 0.80, false) AS flag_schedule_buffer,
  coalesce(total_delay_cost > total_revenue * 0.05, false) AS flag_prioritize_top_category,
  coalesce(occ < 0.5 AND on_time_rate >= 0.85, false) AS flag_marketing_opportunity,
  coalesce(cascade_rate > 0.3, false) AS flag_turnaround_review
FROM x"""
    )


def g2(period: tuple) -> str:
    return (
        _pun(period)
        + _top(1, period)
        + f"""
, rev_r AS (SELECT route_id, CAST(sum(total_fare) AS DECIMAL(38,2)) AS total_revenue FROM fct_revenue WHERE {_within(period)} GROUP BY route_id),
trips_r AS (SELECT route_id, count(trip_id) AS trip_count, CAST(sum(passengers_onboard) AS BIGINT) AS total_passengers
  FROM fct_trips WHERE {_within(period)} GROUP BY route_id),
j AS (
  SELECT d.route_id, d.route_name, pun.total_delay_cost AS cost, r.total_revenue AS revenue, pun.on_time_rate * 100.0 AS otp_pct,
    pun.passenger_delay_minutes, pun.sla_breach_rate, pun.severe_trip_count, t.trip_count, t.total_passengers,
    top.top1_category AS dominant_delay_category
  FROM dim_routes d LEFT JOIN pun ON d.route_id = pun.route_id LEFT JOIN rev_r r ON d.route_id = r.route_id
  LEFT JOIN trips_r t ON d.route_id = t.route_id LEFT JOIN top ON d.route_id = top.route_id),
k AS (
  SELECT *, {_ratio('cost', 'revenue')} * 100.0 AS ratio_pct,
    1 + len(list_filter([2, 5, 10], lambda t: revenue > 0 AND 100 * cost > t * revenue)) AS grade
  FROM j),
risk AS (
SELECT route_id, route_name, revenue, cost AS delay_cost, ratio_pct AS delay_cost_to_revenue_pct,
  ['LOW', 'MODERATE', 'HIGH', 'CRITICAL'][grade] AS risk_level, otp_pct,
  passenger_delay_minutes, sla_breach_rate, coalesce(severe_trip_count, 0) AS severe_trip_count,
  coalesce(trip_count, 0) AS trip_count, CAST(coalesce(total_passengers, 0) AS BIGINT) AS total_passengers,
  CAST(cost AS DOUBLE) / {float(period[2])} * 12.0 AS annualized_delay_cost,
  CASE WHEN otp_pct < 85.0 THEN CAST(revenue AS DOUBLE) * 0.02 * (85.0 - otp_pct) ELSE 0.0 END AS churn_risk_revenue,
  CAST(cost AS DOUBLE) * 0.5 AS savings_if_halved,
  dominant_delay_category,
  CASE WHEN dominant_delay_category IS NOT NULL THEN coalesce(c.mitigation, 'general_improvement') END AS mitigation_strategy,
  CAST(row_number() OVER (ORDER BY grade DESC, ratio_pct DESC NULLS LAST, route_id) AS INTEGER) AS exposure_rank,
  coalesce(c.domain IN ('fleet', 'internal_ops'), false) AS own_domain
FROM k LEFT JOIN category_rule c ON c.category = k.dominant_delay_category)"""
    )


def _ranked(column: str) -> str:
    return ", ".join(
        f"max({column}) FILTER (WHERE exposure_rank = {i}) AS top{i}_{name}"
        for i in (1, 2, 3)
        for name in ([{"route_name": "route", "mitigation_strategy": "mitigation", "savings_if_halved": "savings"}[column]])
    )


def portfolio(period: tuple) -> str:
    return g2(period) + f"""
SELECT CAST(sum(delay_cost) AS DECIMAL(38,2)) AS total_delay_cost, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue,
  {_ratio('sum(delay_cost)', 'sum(revenue)')} * 100.0 AS portfolio_ratio_pct,
  count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_routes, count(*) AS route_count,
  CAST(sum(delay_cost) AS DOUBLE) / {float(period[2])} * 12.0 AS total_annualized_exposure,
  {_ranked('route_name')}, {_ranked('mitigation_strategy')}, {_ranked('savings_if_halved')}
FROM risk"""


def actions(period: tuple) -> str:
    return g2(period) + """
SELECT route_id, route_name, exposure_rank, risk_level, risk_level = 'CRITICAL' AS act_now, own_domain AS controllable_category,
  coalesce(revenue > 0 AND 100 * delay_cost > 4 * revenue AND 100 * delay_cost <= 5 * revenue, false) AS watch
FROM risk"""


#: The declared tests, stated here anew: model -> column -> u(nique), n(ot null), or the parent table of a relationship.
DECLARED = {
    "stg_routes": {"route_id": ["u", "n"]},
    "stg_vehicles": {"vehicle_id": ["u", "n"]},
    "stg_trips": {"trip_id": ["u", "n"], "route_id": ["n"]},
    "stg_punctuality_trips": {"trip_id": ["u", "n"], "route_id": ["n"]},
    "stg_bookings": {"booking_id": ["u", "n"], "route_id": ["n"]},
    "stg_scheduled_trips": {"scheduled_trip_id": ["u", "n"], "trip_id": ["u", "n", "stg_punctuality_trips"]},
    "stg_delay_incidents": {"incident_id": ["u", "n"], "trip_id": ["n"]},
    "int_trip_occupancy": {"trip_id": ["u", "n"]},
    "int_booking_revenue": {"booking_id": ["u", "n"]},
    "int_trip_punctuality": {"trip_id": ["u", "n"]},
    "dim_routes": {"route_id": ["u", "n"]},
    "dim_vehicles": {"vehicle_id": ["u", "n"]},
    "dim_date": {"date_key": ["u", "n"]},
    "fct_trips": {"trip_id": ["u", "n"], "route_id": ["n", "dim_routes"], "vehicle_id": ["dim_vehicles"], "date_key": ["n", "dim_date"]},
    "fct_revenue": {"booking_id": ["u", "n"], "route_id": ["n", "dim_routes"], "date_key": ["n"]},
    "fct_punctuality": {"trip_id": ["u", "n"], "route_id": ["n", "dim_routes"], "vehicle_id": ["dim_vehicles"], "date_key": ["n", "dim_date"]},
    "dim_delay_categories": {"delay_category_key": ["u", "n"], "delay_category": ["u", "n"]},
}


def _dq() -> str:
    parts = []
    for model, columns in DECLARED.items():
        for column, tests in columns.items():
            for t in tests:
                found = {
                    "u": f"SELECT count(*) FROM (SELECT 1 FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)",
                    "n": f"SELECT count(*) - count({column}) FROM {model}",
                }.get(t, f"SELECT count(*) FROM {model} WHERE {column} NOT IN (SELECT {column} FROM {t} WHERE {column} IS NOT NULL)")
                name = {"u": "unique", "n": "not_null"}.get(t, "relationships")
                parts.append(f"SELECT '{model}' AS model, '{column}' AS column_name, '{name}' AS test, ({found}) AS failures")
    for model in ("quarantined_incidents", "quarantined_schedules"):
        parts.append(f"SELECT '{model}', 'unparsed_columns', 'quarantine', (SELECT count(*) FROM {model})")
    return "\n" + "\nUNION ALL\n".join(parts)


_FEEDBACK = """
, fb AS (
  SELECT "timestamp", CAST(user_id AS VARCHAR) AS user_name, event_type AS category,
    CASE WHEN k % 3 = 0 THEN 'revenue looks wrong for route ' || CAST(event_id % 25 AS VARCHAR)
         ELSE 'answer ok ' || CAST(k AS VARCHAR) END AS feedback_message,
    CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS is_positive
  FROM feedback_src WHERE event_id % 4 <> 3)"""

REPORT_SQL = {
    "G1_route_report": g1(ALL_YEARS),
    "G2_revenue_at_risk": g2(ALL_YEARS) + "\nSELECT * EXCLUDE (own_domain) FROM risk",
    "G2_portfolio": portfolio(ALL_YEARS),
    "G2_actions": actions(ALL_YEARS),
    "G4_route_report_last_quarter": g1(LAST_QUARTER),
    "G4_revenue_at_risk_last_quarter": g2(LAST_QUARTER) + "\nSELECT * EXCLUDE (own_domain) FROM risk",
    "D1_trips_with_several_incidents": """
        SELECT trip_id, count(*) AS n_records FROM stg_delay_incidents WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1""",
    "D2_trips_without_category": "SELECT trip_id, route_id FROM int_trip_punctuality WHERE main_category IS NULL",
    "D3_incidents_without_assessment": """
        SELECT incident_id, trip_id FROM stg_delay_incidents WHERE trip_id NOT IN (SELECT trip_id FROM run)""",
    "D4_quarantined_incidents": "SELECT * FROM quarantined_incidents",
    "X1_all_feedback": _FEEDBACK + "\nSELECT * FROM fb",
    "D1_duplicate_booking_ids": """
        SELECT booking_id, count(*) AS n_records FROM stg_bookings WHERE booking_id IS NOT NULL
        GROUP BY booking_id HAVING count(*) > 1""",
    "D2_incidents_without_trip": """
        SELECT incident_id, trip_id, route_id FROM stg_delay_incidents WHERE trip_id IS NULL""",
    "D3_orphan_fact_vehicles": """
        SELECT p.trip_id, p.vehicle_id FROM fct_punctuality p
        WHERE p.vehicle_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_vehicles v WHERE v.vehicle_id = p.vehicle_id)""",
    "D4_dq_summary": _dq(),
    "X1_negative_feedback": _FEEDBACK + "\nSELECT * FROM fb WHERE is_positive = 'false'",
    "X1_recent_feedback": _FEEDBACK
    + '\nSELECT * FROM fb ORDER BY "timestamp" DESC, user_name ASC NULLS LAST, feedback_message ASC NULLS LAST LIMIT 20',
    "X2_keyword_feedback": _FEEDBACK
    + "\nSELECT * FROM fb WHERE is_positive = 'false' AND regexp_matches(feedback_message, '(?i)(wrong|incorrect|mismatch)')",
}
