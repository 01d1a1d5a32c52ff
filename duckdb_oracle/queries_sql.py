"""Oracle SQL of the named queries (Q, V, B, M keys). Each body runs after
the prelude CTEs (binding + model layers).

Three labelled relations carry all of them: ``ops`` (completed trips), ``sold``
(bookings) and ``late`` (assessed trips), each with the members that questions
group by looked up once. A question is then one grouping of one of them, with
filtered aggregates for parts and scalar subqueries for other facts."""

from __future__ import annotations

from duckdb_oracle.prelude import half_up_ratio

YEAR, SEASON, QUARTER = 1996, "Summer", 2
ROUTE = "EUROPE - NATION_3"
COMPARE = ("AMERICA - NATION_1", "EUROPE - NATION_3")
DRILL = "RT003"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

LABELLED = """
, ops AS (
  SELECT f.*, d.year, d.quarter, d.month, d.month_name, d.season, d.year_quarter, r.route_name, r.vehicle_type AS route_type
  FROM fct_trips f LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_routes r USING (route_id)
),
sold AS (
  SELECT f.*, d.year, d.quarter, d.year_quarter, r.route_name
  FROM fct_revenue f LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_routes r USING (route_id)
),
late AS (
  SELECT f.* EXCLUDE (route_name, vehicle_type), d.year, d.month, d.month_name, d.year_quarter, d.is_weekday,
    r.route_name, r.distance_km, v.vehicle_type, k.delay_category, k.delay_domain, k.controllability
  FROM fct_punctuality f LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_routes r USING (route_id)
  LEFT JOIN dim_vehicles v USING (vehicle_id)
  LEFT JOIN (SELECT delay_category_key, delay_category, delay_domain, controllability FROM dim_delay_categories) k USING (delay_category_key)
)
"""


def _mean(col: str, where: str = "") -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({col}){f} AS DOUBLE) / nullif(count({col}){f}, 0)"


def _mean_pct1(col: str, where: str = "") -> str:
    """round(avg * 100, 1) of a column with four decimals, exactly (integer half-up)."""
    f = f" FILTER (WHERE {where})" if where else ""
    tenthousandths = f"CAST(sum({col}){f} * 10000 AS HUGEINT)"
    return f"CAST({half_up_ratio(tenthousandths, f'(100 * (count({col}){f}))', 1)} AS DOUBLE)"


def _share(flag: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {flag}) AS DOUBLE) / count(*)"


def _cents(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,2))"


def _change(old: str, new: str) -> str:
    return f"round((CAST({new} AS DOUBLE) - CAST({old} AS DOUBLE)) / CAST(nullif({old}, 0) AS DOUBLE) * 100.0, 1)"


def _per_head() -> str:
    return "CAST(sum(total_fare) AS DOUBLE) / CAST(nullif(sum(passengers), 0) AS DOUBLE)"


def _by(members: str, figures: str, source: str, where: str = "true", having: str = "true") -> str:
    head = f"{members}, " if members else ""
    group = f" GROUP BY {members}" if members else ""
    return f"{LABELLED} SELECT {head}{figures} FROM {source} WHERE {where}{group}" + (f" HAVING {having}" if having != "true" else "")


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_FIRST, _SECOND = "quarter = 1", "quarter = 2"
#: Per route: delay cost and punctuality beside completed revenue, as correlated figures of the route.
_RISK = f"""{LABELLED}
, exposure AS (
  SELECT r.route_name,
    (SELECT sum(total_fare) FROM sold s WHERE s.route_id = r.route_id AND s.booking_status = 'completed') AS income,
    (SELECT struct_pack(cost := sum(estimated_delay_cost_eur), otp := {_share('is_on_time')} * 100.0, n := count(*))
       FROM late p WHERE p.route_id = r.route_id) AS p
  FROM dim_routes r
),
graded AS (
  SELECT route_name, {_cents('coalesce(income, 0)')} AS revenue, {_cents('coalesce(p.cost, 0)')} AS delay_cost,
    if(income > 0, round(CAST(p.cost AS DOUBLE) / CAST(income AS DOUBLE) * 100, 2), 0.0) AS risk_ratio_pct,
    if(p.n = 0, NULL, p.otp) AS otp_pct, nullif(p.n, 0) AS trip_count,
    ['LOW', 'MODERATE', 'HIGH', 'CRITICAL'][1 + len(list_filter([2, 5, 10], lambda t: income > 0 AND 100 * p.cost > t * income))] AS risk_level
  FROM exposure
)"""

QUERY_SQL = {
    "Q1_season_occupancy": _by(
        "route_name, season", f"{_mean_pct1('occupancy_rate')} AS avg_occupancy_pct, count(trip_id) AS trip_count",
        "ops", f"route_name = '{ROUTE}' AND season = '{SEASON}' AND year = {YEAR}"),
    "Q2_revenue_by_route_quarter": _by(
        "route_name, year_quarter", f"{_cents('sum(total_fare)')} AS total_revenue, count(booking_id) AS booking_count",
        "sold", f"year_quarter = '{YEAR}-Q{QUARTER}'"),
    # The quarter pair as filtered aggregates; both facts have to know the route.
    "Q3_quarter_growth": f"""{LABELLED}
        SELECT a.route_name, {_cents('one')} AS q1_revenue, {_cents('two')} AS q2_revenue, {_change('one', 'two')} AS revenue_growth_pct,
          b.q1_occupancy_pct, b.q2_occupancy_pct, {_change('m1', 'm2')} AS occupancy_growth_pct
        FROM (SELECT route_name, sum(total_fare) FILTER (WHERE {_FIRST}) AS one, sum(total_fare) FILTER (WHERE {_SECOND}) AS two
              FROM sold WHERE year = {YEAR} AND quarter <= 2 GROUP BY 1) a,
          (SELECT route_name, {_mean_pct1('occupancy_rate', _FIRST)} AS q1_occupancy_pct, {_mean_pct1('occupancy_rate', _SECOND)} AS q2_occupancy_pct,
              {_mean('occupancy_rate', _FIRST)} AS m1, {_mean('occupancy_rate', _SECOND)} AS m2
            FROM ops WHERE year = {YEAR} AND quarter <= 2 GROUP BY 1) b
        WHERE a.route_name = b.route_name""",
    "Q4_occupancy_by_vehicle_type": f"""
        SELECT vehicle_type, {_mean_pct1('occupancy_rate')} AS avg_occupancy_pct, count(trip_id) AS trip_count
        FROM dim_vehicles JOIN fct_trips USING (vehicle_id) GROUP BY ALL""",
    "Q5_revenue_per_passenger": _by(
        "route_name", f"round({_per_head()}, 2) AS revenue_per_passenger, CAST(sum(passengers) AS BIGINT) AS total_passengers, "
        f"{_cents('sum(total_fare)')} AS total_revenue", "sold", "booking_status = 'completed' AND route_name IS NOT NULL"),
    "Q6_underperforming_routes": f"{LABELLED}"
        f" SELECT route_name, route_type AS vehicle_type, {_mean_pct1('occupancy_rate')} AS avg_occupancy_pct,"
        f" round(avg(vehicle_capacity), 0) AS avg_capacity, count(trip_id) AS trip_count FROM ops WHERE route_name IS NOT NULL"
        f" GROUP BY route_name, route_type HAVING {_mean('occupancy_rate')} < 0.5",
    "Q7_route_comparison": _by(
        "route_name", f"{_cents('sum(total_fare)')} AS q2_revenue, count(booking_id) AS q2_bookings, CAST(sum(passengers) AS BIGINT) AS q2_passengers",
        "sold", f"route_name IN {_in(COMPARE)} AND year_quarter = '{YEAR}-Q{QUARTER}'"),
    "Q8_occupancy_by_route_month": _by(
        "route_name, month_name, month", f"{_mean_pct1('occupancy_rate')} AS avg_occupancy_pct, count(trip_id) AS trip_count",
        "ops", f"year = {YEAR} AND route_name IS NOT NULL"),
    "V1_otp_by_route": _by("route_name", f"{_share('is_on_time')} AS on_time_rate", "late"),
    "V2_avg_delay_by_route": _by("route_name", f"{_mean('departure_delay_minutes')} AS avg_departure_delay", "late"),
    "V3_common_delay_categories": _by("delay_category, delay_domain", "count(*) AS trip_count", "late", "delay_category IS NOT NULL"),
    "V4_sla_breach_by_month_route": _by("route_name, month, month_name", f"{_share('is_sla_breach')} AS sla_breach_rate", "late"),
    "V5_punctuality_by_vehicle_type": _by(
        "vehicle_type", f"{_share('is_on_time')} AS on_time_rate, {_mean('departure_delay_minutes')} AS avg_departure_delay, "
        "count(trip_id) FILTER (WHERE NOT is_on_time) AS delayed_trip_count", "late"),
    "V6_delay_cost_by_quarter": _by("year_quarter", f"{_cents('sum(estimated_delay_cost_eur)')} AS total_delay_cost", "late"),
    "V7_weekend_vs_weekday": _by(
        "is_weekday", f"{_share('is_on_time')} AS on_time_rate, count(trip_id) FILTER (WHERE NOT is_on_time) AS delayed_trip_count", "late"),
    "V8_cascading_by_route": _by("route_name", f"{_share('has_cascading_incident')} AS cascade_rate", "late"),
    "V9_severity_by_route": _by("route_name, delay_severity", "count(*) AS trip_count", "late", "route_name IS NOT NULL"),
    "V10_risk_by_time_of_day": _by("departure_window", f"{_mean('delay_risk_score')} AS avg_delay_risk_score", "late"),
    "B1_punctuality_kpis": _by(
        "", f"count(*) AS total_trips, {_share('is_on_time')} AS otp_rate, {_mean('departure_delay_minutes')} AS avg_delay, "
        f"{_cents('sum(estimated_delay_cost_eur)')} AS total_delay_cost, {_share('is_sla_breach')} AS sla_breach_rate", "late"),
    "B2_severity_distribution": _by("delay_severity", "count(*) AS trip_count", "late"),
    "B3_otp_heatmap": _by("route_name, month_name, month", f"{_share('is_on_time')} * 100.0 AS otp_pct", "late"),
    "B3_otp_heatmap_pivot": f"{LABELLED} SELECT route_name, "
        + ", ".join(f"CAST(nullif(count(*) FILTER (WHERE is_on_time AND month_name = '{m}'), -1) AS DOUBLE) "
                    f"/ nullif(count(*) FILTER (WHERE month_name = '{m}'), 0) * 100.0 AS {m}" for m in MONTHS)
        + " FROM late GROUP BY route_name",
    "B4_category_breakdown": _by(
        "delay_category, delay_domain, controllability", f"count(*) AS incident_trips, {_mean('departure_delay_minutes')} AS avg_delay",
        "late", f"route_id = '{DRILL}' AND delay_category IS NOT NULL"),
    "B5_route_key_metrics": _by(
        "", f"{_share('is_on_time')} * 100.0 AS otp_pct, {_mean('departure_delay_minutes')} AS avg_dep_delay, "
        f"{_share('is_sla_breach')} * 100.0 AS sla_breach_pct, {_share('has_cascading_incident')} * 100.0 AS cascade_pct, "
        f"{_cents('sum(estimated_delay_cost_eur)')} AS total_cost, {_mean('delay_risk_score')} AS avg_risk_score", "late", f"route_id = '{DRILL}'"),
    "B6_monthly_delay_trend": f"{LABELLED}"
        f" SELECT format('{{}}-{{:02d}}', year, month) AS year_month, month_name, {_mean('departure_delay_minutes')} AS avg_delay,"
        f" {_share('is_on_time')} * 100.0 AS otp_pct FROM late WHERE route_id = '{DRILL}' GROUP BY year, month, month_name",
    "B7_operations_kpis": f"""
        SELECT s.*, t.* FROM (SELECT {_cents('sum(total_fare)')} AS total_revenue, {_per_head()} AS revenue_per_passenger FROM fct_revenue) s,
          (SELECT {_mean('occupancy_rate')} AS average_occupancy_rate, count(trip_id) AS trip_count FROM fct_trips) t""",
    "B7_revenue_by_quarter": _by("year_quarter", f"{_cents('sum(total_fare)')} AS total_revenue", "sold"),
    "B7_revenue_of_quarters": _by(
        "year_quarter", f"{_cents('sum(total_fare)')} AS total_revenue", "sold", f"year = {YEAR} AND quarter IN ({QUARTER}, {QUARTER + 1})"),
    "B7_occupancy_by_route": _by("route_name", f"{_mean('occupancy_rate')} AS average_occupancy_rate", "ops"),
    # Both facts stacked: a figure of one fact is NULL in the other's rows and aggregates skip it.
    "B7_route_performance": f"""{LABELLED}
        SELECT route_name, {_cents('sum(total_fare)')} AS total_revenue, {_mean('occupancy_rate')} AS average_occupancy_rate,
          count(trip_id) FILTER (WHERE booking_id IS NULL) AS trip_count, {_per_head()} AS revenue_per_passenger, count(booking_id) AS booking_count
        FROM (FROM ops UNION ALL BY NAME FROM sold) GROUP BY route_name""",
    "M5_filtered_route_performance": f"""{LABELLED}
        SELECT route_name, year_quarter, {_cents('sum(total_fare)')} AS total_revenue,
          nullif(count(trip_id) FILTER (WHERE booking_id IS NULL), 0) AS trip_count, {_mean('occupancy_rate')} AS average_occupancy_rate
        FROM (FROM ops UNION ALL BY NAME FROM sold) WHERE route_name IN {_in(COMPARE)} AND year = {YEAR} GROUP BY ALL""",
    "M5_range_and_missing": _by(
        "route_name", f"{_mean('arrival_delay_minutes')} AS avg_arrival_delay, "
        f"{_share(chr(39).join(['delay_severity IN (', 'major_delay', ', ', 'severe_delay', ')']))} AS severe_delay_rate",
        "late", "distance_km BETWEEN 40 AND 80 AND primary_delay_category IS NULL"),
    "M7_revenue_and_passengers": f"""{LABELLED}
        SELECT route_name, year, {_cents("sum(if(booking_status = 'completed', total_fare, 0)) FILTER (WHERE booking_id IS NOT NULL)")} AS completed_revenue,
          CAST(sum(passengers_onboard) AS BIGINT) AS total_passengers
        FROM (FROM ops UNION ALL BY NAME FROM sold) GROUP BY ALL""",
    "M8_delay_impact": _by(
        "route_name, year_quarter", f"{_mean('arrival_delay_minutes')} AS avg_arrival_delay, "
        "CAST(sum(total_passenger_delay_minutes) AS BIGINT) AS total_passenger_delay_impact, "
        f"{_share(chr(39).join(['delay_severity IN (', 'major_delay', ', ', 'severe_delay', ')']))} AS severe_delay_rate", "late"),
    "M1_delay_fact_rows": f"""{LABELLED}
        SELECT departure_delay_minutes, estimated_delay_cost_eur, sla_threshold_minutes, route_name, year_quarter, delay_category
        FROM late WHERE route_name = '{ROUTE}'""",
    "M4_route_members": "SELECT route_name FROM dim_routes GROUP BY route_name",
    "M4_quarter_members": "SELECT year_quarter FROM dim_date GROUP BY year_quarter",
    "M4_quarters_with_revenue": _by("year_quarter", "", "sold").replace("year_quarter,  FROM", "year_quarter FROM"),
    "M4_route_quarters": f"{LABELLED} SELECT route_name, year_quarter FROM ops UNION SELECT route_name, year_quarter FROM sold",
    "M4_minivan_routes": "SELECT route_name FROM dim_routes WHERE vehicle_type = 'minivan' GROUP BY route_name",
    "B8_revenue_at_risk": f"{_RISK} SELECT * FROM graded",
    "B8_portfolio_totals": f"""{_RISK}
        SELECT {_cents('sum(delay_cost)')} AS total_delay_cost, {_cents('sum(revenue)')} AS total_revenue,
          CAST(sum(delay_cost) AS DOUBLE) / greatest(CAST(sum(revenue) AS DOUBLE), 1.0) * 100.0 AS portfolio_risk_ratio_pct,
          count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_routes, count(*) AS route_count
        FROM graded""",
}
