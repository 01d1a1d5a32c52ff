"""Oracle SQL (DuckDB) per ``queries()`` key."""

from __future__ import annotations

from duckdb_oracle.prelude import with_prelude

LAYER_SQL = {
    "S1_dim_routes": "SELECT * FROM dim_routes",
    "P2_dim_vehicles": "SELECT * FROM dim_vehicles",
    "P3_stg_trips": "SELECT * FROM stg_trips",
    "P4_stg_bookings": "SELECT * FROM stg_bookings",
    "C6_stg_scheduled_trips": "SELECT * FROM stg_scheduled_trips",
    "C13_stg_delay_incidents": "SELECT * FROM stg_delay_incidents",
    "J1_int_trip_occupancy": "SELECT * FROM int_trip_occupancy",
    "J2_int_booking_revenue": "SELECT * FROM int_booking_revenue",
    "A1_incident_rollup": """
        SELECT trip_id, n AS incident_count, late_sum::BIGINT AS total_incident_delay_minutes, late_max AS max_single_delay_minutes,
          people_minutes::BIGINT AS total_passenger_delay_minutes, categories AS delay_categories, domains AS delay_domains,
          any_cascading::INTEGER AS has_cascading_incident, last_severity AS worst_severity, worst_by_rank AS worst_severity_by_rank,
          main_category AS primary_delay_category
        FROM incident_fold""",
    "W5_int_trip_punctuality": """
        SELECT scheduled_trip_id, trip_id, route_id, vehicle_id, route_name, distance_km, vehicle_type, service_type,
          departure_window, is_weekend_service, schedule_density, scheduled_departure_at, scheduled_arrival_at,
          scheduled_duration_minutes, actual_departure_at, actual_arrival_at, actual_duration_minutes,
          departure_delay_minutes, arrival_delay_minutes, travel_time_ratio, is_on_time_departure, is_on_time_arrival,
          is_on_time, delay_severity, CAST(incident_count AS BIGINT) AS incident_count,
          CAST(total_incident_delay_minutes AS BIGINT) AS total_incident_delay_minutes, max_single_delay_minutes,
          CAST(total_passenger_delay_minutes AS BIGINT) AS total_passenger_delay_minutes, delay_categories, delay_domains,
          has_cascading_incident, incident_worst_severity, vehicle_rolling_avg_delay_5trips, prev_trip_delay_minutes,
          vehicle_turnaround_minutes, is_probable_cascade, delay_rank_on_route_day, route_day_avg_delay,
          delay_risk_score, passengers_onboard, trip_date
        FROM int_trip_punctuality""",
    "P6_fct_trips": "SELECT * FROM fct_trips",
    "P6_fct_revenue": "SELECT * FROM fct_revenue",
    "C24_fct_punctuality": """
        SELECT * REPLACE (CAST(incident_count AS BIGINT) AS incident_count,
          CAST(total_incident_delay_minutes AS BIGINT) AS total_incident_delay_minutes,
          CAST(total_passenger_delay_minutes AS BIGINT) AS total_passenger_delay_minutes)
        FROM fct_punctuality""",
    "C20_dim_delay_categories": "SELECT * FROM dim_delay_categories",
    "X0_dim_date": """
        SELECT d.*, (SELECT count(*) FROM fct_trips f WHERE f.date_key = d.date_key) AS trip_count,
          (SELECT count(*) FROM fct_revenue f WHERE f.date_key = d.date_key) AS booking_count,
          (SELECT count(*) FROM fct_punctuality f WHERE f.date_key = d.date_key) AS assessed_trip_count
        FROM dim_date d""",
    "S1_seeded_routes": "SELECT * FROM stg_routes",
    "S3_routes_view": """
        SELECT route_id, route_name, (SELECT count(*) FROM fct_trips t WHERE t.route_id = r.route_id) AS trip_count FROM dim_routes r""",
    "S4_published_marts": """
        SELECT r.route_id, r.route_name, d.year_quarter, count(*) AS trip_count, sum(f.passengers_onboard)::BIGINT AS passengers
        FROM fct_trips f JOIN dim_date d USING (date_key) LEFT JOIN dim_routes r ON r.route_id = f.route_id
        WHERE year(f.date_key) = 1996
        GROUP BY ALL""",
    "P7_reconciliation": """
        SELECT * FROM (WITH told AS (
          SELECT 'trips' AS input, if(trip_status = 'completed', 'kept', 'not completed') AS outcome FROM raw_trips
          UNION ALL SELECT 'punctuality_trips', if(trip_status = 'completed', 'kept', 'not completed') FROM raw_punctuality_trips
          UNION ALL SELECT 'bookings', 'kept' FROM raw_bookings
          UNION ALL SELECT 'scheduled_trips', 'quarantined' FROM quarantined_schedules
          UNION ALL SELECT 'scheduled_trips', if(_is_invalid_schedule, 'invalid schedule', 'kept') FROM stg_scheduled_trips
          UNION ALL SELECT 'delay_incidents', 'quarantined' FROM quarantined_incidents
          UNION ALL SELECT 'delay_incidents', if(_is_invalid_record, 'invalid record', 'kept') FROM stg_delay_incidents),
        outcomes(input, outcome) AS (VALUES ('trips', 'kept'), ('trips', 'not completed'), ('punctuality_trips', 'kept'),
          ('punctuality_trips', 'not completed'), ('bookings', 'kept'), ('scheduled_trips', 'kept'), ('scheduled_trips', 'quarantined'),
          ('scheduled_trips', 'invalid schedule'), ('delay_incidents', 'kept'), ('delay_incidents', 'quarantined'), ('delay_incidents', 'invalid record'))
        SELECT input, outcome, (SELECT count(*) FROM told t WHERE t.input = o.input AND t.outcome = o.outcome) AS n_rows FROM outcomes o
        UNION ALL SELECT input, 'read', count(*) FROM told GROUP BY input)""",
    "X1_event_reconciliation": """
        SELECT CASE WHEN epoch_us("timestamp") % 97 = 0 THEN 'malformed: value'
            WHEN event_id % 4 = 3 THEN 'other record' ELSE 'feedback' END AS outcome,
          count(*) AS n_rows, count(*) FILTER (WHERE k % 2 <> 0 AND epoch_us("timestamp") % 97 <> 0) AS n_negative
        FROM feedback_src GROUP BY 1""",
    "M3_rollup_by_season": """
        SELECT * FROM (WITH t AS (
          SELECT season, origin, count(trip_id) AS trip_count, sum(occupancy_rate)::DOUBLE / count(occupancy_rate) AS average_occupancy_rate
          FROM fct_trips JOIN dim_date USING (date_key) LEFT JOIN dim_routes USING (route_id) WHERE year IN (1996, 1997) GROUP BY ALL),
        r AS (
          SELECT season, origin, sum(total_fare)::DECIMAL(38,2) AS total_revenue, count(booking_id) AS booking_count,
            sum(total_fare)::DOUBLE / sum(passengers) AS revenue_per_passenger
          FROM fct_revenue JOIN dim_date USING (date_key) LEFT JOIN dim_routes USING (route_id) WHERE year IN (1996, 1997) GROUP BY ALL)
        SELECT coalesce(t.season, r.season) AS season, coalesce(t.origin, r.origin) AS origin, total_revenue, booking_count,
          revenue_per_passenger, trip_count, average_occupancy_rate
        FROM t FULL JOIN r ON t.season = r.season AND t.origin IS NOT DISTINCT FROM r.origin)""",
    "J3_colocated_comparison": """
        SELECT scheduled_trip_id, trip_id, route_id, route_name, departure_delay_minutes, arrival_delay_minutes,
          CAST(incident_count AS BIGINT) AS incident_count, CAST(total_incident_delay_minutes AS BIGINT) AS total_incident_delay_minutes,
          delay_categories, delay_domains, has_cascading_incident, incident_worst_severity, main_category AS primary_delay_category
        FROM int_trip_punctuality""",
    "S4_refreshed_months": """
        SELECT 'fct_trips' AS table_name, year(date_key) * 100 + month(date_key) AS month_key, count(*) AS n_rows,
          sum(passengers_onboard)::BIGINT AS sum_a, 0::BIGINT AS sum_b, year(date_key) * 100 + month(date_key) = 199603 AS is_rewritten
        FROM fct_trips GROUP BY ALL
        UNION ALL
        SELECT 'fct_revenue', year(date_key) * 100 + month(date_key), count(*), sum(passengers)::BIGINT, 0, false FROM fct_revenue GROUP BY ALL
        UNION ALL
        SELECT 'fct_punctuality', month_key, count(*), sum(delay_risk_score)::BIGINT, sum(vehicle_turnaround_minutes)::BIGINT,
          month_key = 202405 OR bool_or(coalesce(list_contains(back, 202405), false))
        FROM (SELECT *, year(trip_date) * 100 + month(trip_date) AS month_key,
            list(year(trip_date) * 100 + month(trip_date)) OVER (PARTITION BY vehicle_id
              ORDER BY actual_departure_at NULLS LAST, trip_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS back
          FROM int_trip_punctuality)
        GROUP BY month_key""",
    "A5_route_benchmarks": """
        SELECT route_id, round(q[1], 9) AS p50_departure_delay, round(q[2], 9) AS p75_departure_delay,
          round(q[3], 9) AS p90_departure_delay, round(q[4], 9) AS p95_departure_delay,
          round(mean, 9) AS route_avg_departure_delay, round(spread, 9) AS route_stddev_departure_delay
        FROM route_stats""",
}


def all_sql() -> dict[str, str]:
    from duckdb_oracle.queries_sql import QUERY_SQL
    from duckdb_oracle.reports_sql import REPORT_SQL

    out = {k: with_prelude(v) for k, v in LAYER_SQL.items()}
    out.update({k: with_prelude(v) for k, v in QUERY_SQL.items()})
    out.update({k: with_prelude(v) for k, v in REPORT_SQL.items()})
    # The same rows by another way.
    out["W5_colocated_punctuality"] = out["W5_int_trip_punctuality"]
    out["D3_filtered_orphans"] = out["D3_incidents_without_assessment"]
    return out
