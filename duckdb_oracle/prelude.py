"""DuckDB SQL for the test binding and the model layers (the oracle side).

Every rule is a row of a rule table (``VALUES``): hour bands, delay bands,
severity limits and category attributes are looked up, not written as
conditional chains. Measures are then derived in steps of their own:

* ``incident``      typed incidents with looked-up attributes
* ``incident_fold`` one row per trip: sums, ordered lists, the worst incident
* ``run``           a schedule that was executed, with its delays
* ``run_seen``      the run with its vehicle's and its route-day's context
* ``assessed``      the run with scores; ``route_stats`` beside it

Averages of decimals are ``sum / count`` in double, and decimal ratios are
rounded half-up with integer arithmetic, because DuckDB turns decimal
division into double.
"""

from __future__ import annotations


def _rt(expr: str) -> str:
    return f"('RT' || lpad(CAST({expr} AS VARCHAR), 3, '0'))"


def half_up_ratio(num: str, den: str, scale: int, precision: int = 10) -> str:
    """round(num / nullif(den, 0), scale) for non-negative integer num and
    positive den, exactly, as decimal(precision, scale)."""
    m = 10**scale
    step = "0." + "0" * (scale - 1) + "1"
    return (
        f"CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE "
        f"CAST(CAST(((CAST({num} AS HUGEINT) * {2 * m} + ({den})) // (2 * CAST({den} AS HUGEINT))) AS DECIMAL(18,0)) * {step} "
        f"AS DECIMAL({precision},{scale})) END"
    )


BINDING = f"""
veh_attrs AS (
  SELECT c_custkey AS _custkey, c_nationkey AS _nationkey,
    CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'minivan' ELSE 'shuttle_bus' END AS _vehicle_type,
    CAST(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 8 + (c_custkey % 2) * 4
              ELSE 40 + (c_custkey % 4) * 5 END AS INTEGER) AS _capacity
  FROM customer
),
raw_routes AS (
  SELECT {_rt('n_nationkey')} AS route_id,
    r_name || ' - ' || n_name AS route_name,
    r_name AS origin, n_name AS destination,
    CAST(40 + (n_nationkey * 37) % 81 AS INTEGER) AS distance_km,
    CASE WHEN n_nationkey % 3 = 0 THEN 'minivan' ELSE 'shuttle_bus' END AS vehicle_type,
    CAST(10 + n_nationkey % 20 AS DECIMAL(18,2)) AS base_fare_eur,
    CAST(3 + n_nationkey % 6 AS INTEGER) AS frequency_daily
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
raw_vehicles AS (
  SELECT CAST(_custkey AS VARCHAR) AS vehicle_id, _vehicle_type AS vehicle_type, _capacity AS capacity,
    'REG-' || lpad(CAST(_custkey AS VARCHAR), 7, '0') AS registration_plate,
    CAST(2020 + _custkey % 5 AS INTEGER) AS year_manufactured, 'active' AS status
  FROM veh_attrs
),
raw_trips AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, {_rt('_nationkey')} AS route_id,
    CAST(o_custkey AS VARCHAR) AS vehicle_id,
    dep AS departure_datetime,
    dep + to_minutes(CAST(30 + o_orderkey % 61 AS BIGINT)) AS arrival_datetime,
    _capacity AS vehicle_capacity,
    CAST((o_orderkey * 31) % (_capacity + 1) AS INTEGER) AS passengers_onboard,
    CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'completed' END AS trip_status
  FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) AS dep FROM orders) o
  JOIN veh_attrs ON o_custkey = _custkey
),
raw_bookings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS booking_id,
    CAST(l_orderkey AS VARCHAR) AS trip_id, {_rt('c_nationkey')} AS route_id,
    CAST(l_shipdate AS TIMESTAMP) AS booking_datetime,
    pax AS passengers, fare AS fare_per_passenger, CAST(fare * pax AS DECIMAL(18,2)) AS total_fare,
    CASE l_linenumber % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'paypal'
      WHEN 3 THEN 'ideal' WHEN 4 THEN 'bancontact' END AS payment_method,
    CASE WHEN l_returnflag = 'R' THEN 'refunded'
         WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'no_show'
         WHEN l_returnflag = 'A' THEN 'cancelled' ELSE 'completed' END AS booking_status,
    CASE l_linenumber % 3 WHEN 0 THEN 'website' WHEN 1 THEN 'mobile_app' WHEN 2 THEN 'partner_api' END AS channel
  FROM (SELECT *, CAST(1 + CAST(floor(l_quantity) AS INTEGER) % 4 AS INTEGER) AS pax,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS fare FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
),
raw_punctuality_trips AS (
  SELECT CAST(event_id AS VARCHAR) AS trip_id, {_rt('event_id % 25')} AS route_id,
    CAST(user_id AS VARCHAR) AS vehicle_id,
    (CAST(ts AS TIMESTAMP) + to_days(CAST((event_id // 3) % 12 * 28 AS INTEGER))) AS departure_datetime,
    (CAST(ts AS TIMESTAMP) + to_days(CAST((event_id // 3) % 12 * 28 AS INTEGER))) + to_minutes(CAST(30 + event_id % 61 AS BIGINT)) AS arrival_datetime,
    _capacity AS vehicle_capacity,
    CAST((event_id * 31) % (_capacity + 1) AS INTEGER) AS passengers_onboard,
    CASE WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'cancelled' ELSE 'completed' END AS trip_status
  FROM events JOIN veh_attrs ON user_id = _custkey
),
raw_scheduled_trips AS (
  SELECT 'S' || CAST(event_id AS VARCHAR) AS scheduled_trip_id, CAST(event_id AS VARCHAR) AS trip_id,
    {_rt('event_id % 25')} AS route_id, CAST(user_id AS VARCHAR) AS vehicle_id,
    dep AS scheduled_departure_at,
    CASE WHEN event_id % 97 = 0 THEN dep
         ELSE dep + to_minutes(CAST(30 + event_id % 61 - event_id % 7 AS BIGINT)) END AS scheduled_arrival_at,
    CASE event_id % 3 WHEN 0 THEN ' Regular' WHEN 1 THEN 'EXPRESS ' WHEN 2 THEN 'Peak_Hour' END AS service_type,
    '2024-Q' || CAST(1 + event_id % 4 AS VARCHAR) AS schedule_version
  FROM (SELECT *, (CAST(ts AS TIMESTAMP) + to_days(CAST((event_id // 3) % 12 * 28 AS INTEGER))) + to_seconds(300 - CAST(floor(value * 30) AS BIGINT)) AS dep FROM events) e
),
raw_delay_incidents AS (
  SELECT 'I' || CAST(event_id AS VARCHAR) AS incident_id,
    CAST(event_id - event_id % 3 AS VARCHAR) AS trip_id,
    {_rt('(event_id - event_id % 3) % 25')} AS route_id,
    CASE event_id % 8 WHEN 0 THEN ' Traffic_Congestion' WHEN 1 THEN 'road_closure ' WHEN 2 THEN 'WEATHER_CONDITIONS'
      WHEN 3 THEN 'mechanical_issue' WHEN 4 THEN ' Passenger_Boarding ' WHEN 5 THEN 'security_check'
      WHEN 6 THEN 'Operational_Handover' WHEN 7 THEN 'other' END AS delay_category,
    CASE WHEN event_id % 499 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
      || CASE WHEN event_id % 211 = 0 THEN '.5' ELSE '' END END AS delay_minutes,
    CASE event_id % 3 WHEN 0 THEN ' Low' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'high ' END AS impact_level,
    (CAST(ts AS TIMESTAMP) + to_days(CAST((event_id // 3) % 12 * 28 AS INTEGER))) AS reported_at,
    (CAST(ts AS TIMESTAMP) + to_days(CAST((event_id // 3) % 12 * 28 AS INTEGER))) + to_minutes(CAST((event_id * 37) % 90 - 2 AS BIGINT)) AS resolved_at,
    CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS is_cascading,
    CAST(user_id % 50 AS VARCHAR) AS affected_passengers
  FROM events
),
feedback_src AS (
  SELECT CAST(ts AS TIMESTAMP) AS "timestamp", event_id, user_id, event_type,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""


# --- fixed values (rule tables) ----------------------------------------------
RULES = """
hour_rule(rule, first_hour, last_hour, label) AS (VALUES
  ('departure', 5, 8, 'early_morning'), ('departure', 9, 11, 'morning'), ('departure', 12, 14, 'midday'),
  ('departure', 15, 17, 'afternoon'), ('departure', 18, 20, 'evening'),
  ('density', 7, 9, 'high'), ('density', 10, 15, 'medium'), ('density', 16, 18, 'high'),
  ('report', 6, 9, 'morning_rush'), ('report', 10, 15, 'midday'), ('report', 16, 19, 'evening_rush')
),
severity_rule(place, over_minutes, over_people, label) AS (VALUES
  (1, 40, 30, 'critical'), (2, 30, NULL, 'severe'), (3, 20, 25, 'severe'),
  (4, 15, NULL, 'moderate'), (5, 10, 20, 'moderate'), (6, 5, NULL, 'minor')
),
minute_rule(rule, up_to, label) AS (VALUES
  ('resolution', 15, 'rapid'), ('resolution', 45, 'standard'),
  ('delay', 5, 'on_time'), ('delay', 15, 'minor_delay'), ('delay', 30, 'moderate_delay'), ('delay', 60, 'major_delay')
),
category_rule(category, domain, sla, tier, mitigation, cascade) AS (VALUES
  ('traffic_congestion', 'infrastructure', 20, 'high_frequency', 'route_optimization', 0.50),
  ('road_closure', 'infrastructure', 30, 'low_frequency', 'route_optimization', 0.70),
  ('weather_conditions', 'environmental', 45, 'medium_frequency', 'proactive_scheduling', 0.60),
  ('mechanical_issue', 'fleet', 60, 'low_frequency', 'preventive_maintenance', 0.85),
  ('passenger_boarding', 'passenger_ops', 10, 'high_frequency', 'process_improvement', 0.20),
  ('security_check', 'passenger_ops', 20, 'low_frequency', 'pre_clearance', 0.15),
  ('operational_handover', 'internal_ops', 15, 'medium_frequency', 'staff_training', 0.40)
),
domain_rule(domain, control) AS (VALUES
  ('internal_ops', 'fully_controllable'), ('fleet', 'partially_controllable'), ('passenger_ops', 'partially_controllable'),
  ('infrastructure', 'uncontrollable'), ('environmental', 'uncontrollable')
),
season_rule(month_no, season) AS (VALUES
  (1, 'Winter'), (2, 'Winter'), (3, 'Spring'), (4, 'Spring'), (5, 'Spring'), (6, 'Summer'),
  (7, 'Summer'), (8, 'Summer'), (9, 'Autumn'), (10, 'Autumn'), (11, 'Autumn'), (12, 'Winter')
)"""
# ------------------------------------------------------------------------------


def _hour(rule: str, ts: str, default: str) -> str:
    return (
        f"coalesce((SELECT min(h.label) FROM hour_rule h WHERE h.rule = '{rule}' "
        f"AND hour({ts}) >= h.first_hour AND hour({ts}) <= h.last_hour), '{default}')"
    )


def _minutes(rule: str, value: str, default: str) -> str:
    return f"coalesce((SELECT arg_min(m.label, m.up_to) FROM minute_rule m WHERE m.rule = '{rule}' AND {value} <= m.up_to), '{default}')"


def _yes(cond: str) -> str:
    """A condition as a flag: unknown is false."""
    return f"coalesce({cond}, false)"


def _int(text: str) -> str:
    """A text as a whole number, half away from zero; NULL if it is none."""
    return f"TRY_CAST(round(TRY_CAST({text} AS DECIMAL(28,8)), 0) AS INTEGER)"


STAGING = f"""
stg_routes AS (FROM raw_routes),
stg_vehicles AS (FROM raw_vehicles),
executed AS (
  SELECT 'o' AS part, * FROM raw_trips UNION ALL SELECT 'p', * FROM raw_punctuality_trips
),
executed_typed AS (
  SELECT part, trip_id, route_id, vehicle_id, departure_datetime::TIMESTAMP AS departure_at, arrival_datetime::TIMESTAMP AS arrival_at,
    vehicle_capacity, passengers_onboard, trip_status FROM executed
),
stg_trips AS (SELECT * EXCLUDE (part) FROM executed_typed WHERE part = 'o'),
stg_punctuality_trips AS (SELECT * EXCLUDE (part) FROM executed_typed WHERE part = 'p'),
stg_bookings AS (SELECT * EXCLUDE (booking_datetime), booking_datetime::TIMESTAMP AS booked_at FROM raw_bookings),
stg_scheduled_trips AS (
  SELECT q.scheduled_trip_id, q.trip_id, q.route_id, q.vehicle_id, q.scheduled_departure_at, q.scheduled_arrival_at,
    q.planned AS scheduled_duration_minutes, lower(trim(q.service_type)) AS service_type,
    {_hour('departure', 'q.scheduled_departure_at', 'night')} AS departure_window,
    {_yes('dayofweek(q.scheduled_departure_at) % 6 = 0')} AS is_weekend_service,
    {_hour('density', 'q.scheduled_departure_at', 'low')} AS schedule_density,
    q.schedule_version, TRY_CAST(regexp_extract(q.schedule_version, 'Q([1-4])', 1) AS INTEGER) AS schedule_quarter,
    TRY_CAST(q.schedule_version[1:4] AS INTEGER) AS schedule_year,
    {_yes('q.planned <= 0 OR q.scheduled_departure_at >= q.scheduled_arrival_at')} AS _is_invalid_schedule
  FROM (SELECT *, date_diff('minute', scheduled_departure_at, scheduled_arrival_at) AS planned FROM raw_scheduled_trips) q
  WHERE q.schedule_version IS NULL OR TRY_CAST(q.schedule_version[1:4] AS INTEGER) IS NOT NULL
),
quarantined_schedules AS (
  SELECT scheduled_trip_id, trip_id, schedule_version, 'schedule_version' AS unparsed_columns FROM raw_scheduled_trips
  WHERE schedule_version IS NOT NULL AND TRY_CAST(schedule_version[1:4] AS INTEGER) IS NULL
),
incident_read AS (
  SELECT *, {_int('delay_minutes')} AS late, {_int('affected_passengers')} AS people, TRY_CAST(is_cascading AS BOOLEAN) AS spreads,
    lower(trim(delay_category)) AS category, date_diff('minute', reported_at, resolved_at) AS took
  FROM raw_delay_incidents
),
incident_problem AS (
  SELECT incident_id, array_to_string(list_filter([
      CASE WHEN delay_minutes IS NOT NULL AND late IS NULL THEN 'delay_minutes' END,
      CASE WHEN is_cascading IS NOT NULL AND spreads IS NULL THEN 'is_cascading' END,
      CASE WHEN affected_passengers IS NOT NULL AND people IS NULL THEN 'affected_passengers' END], lambda x: x IS NOT NULL), ',') AS problem
  FROM incident_read
),
quarantined_incidents AS (
  SELECT r.incident_id, r.trip_id, r.delay_minutes, r.is_cascading, r.affected_passengers, p.problem AS unparsed_columns
  FROM incident_read r JOIN incident_problem p USING (incident_id) WHERE p.problem <> ''
),
stg_delay_incidents AS (
  SELECT r.incident_id, r.trip_id, r.route_id, r.category AS delay_category, coalesce(c.domain, 'unknown') AS delay_domain,
    r.late AS delay_minutes, lower(trim(r.impact_level)) AS impact_level,
    coalesce((SELECT arg_min(v.label, v.place) FROM severity_rule v
      WHERE r.late > v.over_minutes AND (v.over_people IS NULL OR r.people > v.over_people)), 'negligible') AS computed_severity,
    r.late::BIGINT * r.people AS passenger_delay_minutes, r.reported_at, r.resolved_at, r.took AS resolution_minutes,
    {_minutes('resolution', 'r.took', 'prolonged')} AS resolution_category,
    {_hour('report', 'r.reported_at', 'off_peak')} AS incident_time_band,
    r.spreads AS is_cascading, r.people AS affected_passengers,
    {_yes('2 * r.took < r.late')} AS _is_rapid_resolution_anomaly,
    {_yes('r.late <= 0')} OR {_yes('r.resolved_at < r.reported_at')} AS _is_invalid_record
  FROM incident_read r JOIN incident_problem p USING (incident_id) LEFT JOIN category_rule c ON c.category = r.category
  WHERE p.problem = ''
)"""


INTERMEDIATE = f"""
int_trip_occupancy AS (
  SELECT trip_id, route_id, route_name, origin, destination, vehicle_id, departure_at, arrival_at, vehicle_capacity,
    passengers_onboard, {half_up_ratio('passengers_onboard', 'vehicle_capacity', 4)} AS occupancy_rate,
    trip_status, departure_at::DATE AS trip_date
  FROM stg_trips LEFT JOIN (SELECT route_id, route_name, origin, destination FROM stg_routes) USING (route_id)
  WHERE trip_status = 'completed'
),
int_booking_revenue AS (
  SELECT booking_id, trip_id, route_id, route_name, origin, destination, booked_at, booked_at::DATE AS booking_date,
    passengers, fare_per_passenger, total_fare, payment_method, booking_status, channel
  FROM stg_bookings LEFT JOIN (SELECT route_id, route_name, origin, destination FROM stg_routes) USING (route_id)
),
incident AS (FROM stg_delay_incidents WHERE NOT _is_invalid_record),
incident_fold AS (
  SELECT trip_id, count(*) AS n, sum(delay_minutes) AS late_sum, max(delay_minutes) AS late_max, sum(passenger_delay_minutes) AS people_minutes,
    array_to_string(list_sort(list(DISTINCT delay_category) FILTER (WHERE delay_category IS NOT NULL)), ', ') AS categories,
    array_to_string(list_sort(list(DISTINCT delay_domain)), ', ') AS domains,
    bool_or({_yes('is_cascading')}) AS any_cascading, max(computed_severity) AS last_severity,
    arg_max(computed_severity, list_position(['negligible', 'minor', 'moderate', 'severe', 'critical'], computed_severity)) AS worst_by_rank,
    first(delay_category ORDER BY delay_minutes DESC NULLS FIRST, incident_id) AS main_category
  FROM incident GROUP BY trip_id
),
run AS (
  SELECT s.* EXCLUDE (_is_invalid_schedule, schedule_version, schedule_quarter, schedule_year),
    t.departure_at AS actual_departure_at, t.arrival_at AS actual_arrival_at, t.passengers_onboard, t.departure_at::DATE AS trip_date,
    date_diff('minute', s.scheduled_departure_at, t.departure_at) AS departure_delay_minutes,
    date_diff('minute', s.scheduled_arrival_at, t.arrival_at) AS arrival_delay_minutes,
    date_diff('minute', t.departure_at, t.arrival_at) AS actual_duration_minutes
  FROM stg_scheduled_trips s, stg_punctuality_trips t
  WHERE s.trip_id = t.trip_id AND t.trip_status = 'completed' AND NOT s._is_invalid_schedule
),
run_seen AS (
  SELECT run.*,
    {_yes('departure_delay_minutes <= 5')} AS is_on_time_departure, {_yes('arrival_delay_minutes <= 5')} AS is_on_time_arrival,
    {_minutes('delay', 'departure_delay_minutes', 'severe_delay')} AS delay_severity,
    avg(departure_delay_minutes) OVER (along ROWS 4 PRECEDING) AS vehicle_rolling_avg_delay_5trips,
    lag(departure_delay_minutes) OVER along AS prev_trip_delay_minutes,
    date_diff('minute', lag(actual_arrival_at) OVER along, actual_departure_at) AS vehicle_turnaround_minutes,
    (1 + count(*) OVER (PARTITION BY route_id, trip_date ORDER BY departure_delay_minutes DESC NULLS FIRST
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP))::INTEGER AS delay_rank_on_route_day,
    avg(departure_delay_minutes) OVER (PARTITION BY route_id, trip_date) AS route_day_avg_delay
  FROM run WINDOW along AS (PARTITION BY vehicle_id ORDER BY actual_departure_at NULLS LAST, trip_id)
),
int_trip_punctuality AS (
  SELECT x.*, r.route_name, r.distance_km, r.vehicle_type,
    {half_up_ratio('x.actual_duration_minutes', 'x.scheduled_duration_minutes', 3)} AS travel_time_ratio,
    x.is_on_time_departure AND x.is_on_time_arrival AS is_on_time,
    coalesce(f.n, 0) AS incident_count, coalesce(f.late_sum, 0) AS total_incident_delay_minutes,
    f.late_max AS max_single_delay_minutes, coalesce(f.people_minutes, 0) AS total_passenger_delay_minutes,
    f.categories AS delay_categories, f.domains AS delay_domains, coalesce(f.any_cascading, false) AS has_cascading_incident,
    f.last_severity AS incident_worst_severity, f.main_category,
    coalesce(x.prev_trip_delay_minutes > 10, false) AND coalesce(x.vehicle_turnaround_minutes < 60, false) AS is_probable_cascade,
    CASE WHEN x.departure_delay_minutes IS NOT NULL THEN
      CAST(least(100, greatest(0, x.departure_delay_minutes * 1.5 + 5 * coalesce(f.n, 0)
        + list_sum([if(x.is_on_time_departure AND x.is_on_time_arrival, 0, 10), if(coalesce(f.any_cascading, false), 15, 0),
                    if(coalesce(x.vehicle_rolling_avg_delay_5trips > 15, false), 20, 0)])::INTEGER)) AS INTEGER) END AS delay_risk_score
  FROM run_seen x LEFT JOIN stg_routes r USING (route_id) LEFT JOIN incident_fold f USING (trip_id)
)"""


MARTS = """
dim_routes AS (FROM stg_routes),
dim_vehicles AS (FROM stg_vehicles),
dim_date AS (
  SELECT day AS date_key, day AS full_date, year(day)::INTEGER AS year, month(day)::INTEGER AS month,
    day(day)::INTEGER AS day_of_month, dayofweek(day)::INTEGER AS day_of_week,
    format('{}-Q{}', year(day), quarter(day)) AS year_quarter, quarter(day)::INTEGER AS quarter,
    monthname(day)[1:3] AS month_name, dayname(day)[1:3] AS day_name, season, dayofweek(day) BETWEEN 1 AND 5 AS is_weekday
  FROM (SELECT unnest(range(DATE '1995-01-01', DATE '2025-01-01', INTERVAL 1 DAY))::DATE AS day) JOIN season_rule ON month_no = month(day)
),
dim_delay_categories AS (
  SELECT md5(i.delay_category) AS delay_category_key, i.delay_category, i.delay_domain, coalesce(d.control, 'unknown') AS controllability,
    coalesce(c.sla, 30)::INTEGER AS sla_threshold_minutes, coalesce(c.tier, 'low_frequency') AS expected_frequency_tier,
    coalesce(c.mitigation, 'general_improvement') AS mitigation_strategy, coalesce(c.cascade, 0.30)::DECIMAL(3,2) AS cascade_risk_factor
  FROM (SELECT delay_category, delay_domain FROM incident GROUP BY ALL) i
  LEFT JOIN category_rule c ON c.category = i.delay_category LEFT JOIN domain_rule d ON d.domain = i.delay_domain
),
fct_trips AS (SELECT trip_id, route_id, vehicle_id, trip_date AS date_key, departure_at, arrival_at,
    vehicle_capacity, passengers_onboard, occupancy_rate, trip_status FROM int_trip_occupancy),
fct_revenue AS (SELECT booking_id, trip_id, route_id, booking_date AS date_key, booked_at, passengers,
    fare_per_passenger, total_fare, payment_method, booking_status, channel FROM int_booking_revenue),
route_stats AS (
  SELECT route_id, quantile_cont(departure_delay_minutes, [0.50, 0.75, 0.90, 0.95]) AS q,
    avg(departure_delay_minutes) AS mean, stddev_samp(departure_delay_minutes) AS spread
  FROM int_trip_punctuality GROUP BY route_id
),
fct_punctuality AS (
  SELECT a.trip_id, a.route_id, a.vehicle_id, a.trip_date AS date_key, a.route_name, a.vehicle_type, a.service_type, a.departure_window,
    a.is_weekend_service, a.schedule_density, a.scheduled_departure_at, a.scheduled_arrival_at, a.scheduled_duration_minutes,
    a.actual_departure_at, a.actual_arrival_at, a.actual_duration_minutes, a.departure_delay_minutes, a.arrival_delay_minutes,
    a.travel_time_ratio, a.is_on_time_departure, a.is_on_time_arrival, a.is_on_time, a.delay_severity, a.incident_count,
    a.total_incident_delay_minutes, a.max_single_delay_minutes, a.total_passenger_delay_minutes, a.delay_categories, a.delay_domains,
    a.has_cascading_incident, a.incident_worst_severity, a.vehicle_rolling_avg_delay_5trips, a.is_probable_cascade,
    a.vehicle_turnaround_minutes, a.delay_risk_score, a.passengers_onboard,
    a.main_category AS primary_delay_category, k.delay_category_key, k.controllability AS delay_controllability, k.sla_threshold_minutes,
    coalesce(a.departure_delay_minutes > k.sla_threshold_minutes, false) AS is_sla_breach,
    s.q[1] AS route_p50_delay, s.q[2] AS route_p75_delay, s.q[3] AS route_p90_delay, s.mean AS route_avg_departure_delay,
    ['below_median', 'p50_to_p75', 'p75_to_p90', 'above_p90'][
      coalesce(1 + len(list_filter(s.q[1:3], lambda e: a.departure_delay_minutes > e)), 4)] AS route_delay_percentile_band,
    if(s.spread > 0, round((a.departure_delay_minutes - s.mean) / s.spread, 2), 0.0) AS delay_z_score,
    CAST(if(a.departure_delay_minutes IS NULL, NULL, greatest(a.departure_delay_minutes - 5, 0)) * a.passengers_onboard * 0.50 AS DECIMAL(18,2))
      AS estimated_delay_cost_eur
  FROM int_trip_punctuality a JOIN route_stats s ON s.route_id = a.route_id
  LEFT JOIN dim_delay_categories k ON k.delay_category = a.main_category
)"""


PRELUDE = "WITH " + ",".join([BINDING, RULES, STAGING, INTERMEDIATE, MARTS])


def with_prelude(body: str) -> str:
    """Prefix a final SELECT with the binding and model CTEs."""
    return PRELUDE + "\n" + body.strip()
