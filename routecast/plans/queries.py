"""Named queries: the verified questions (Q1-Q8), the semantic verified
questions (V1-V10) and the dashboard queries (B1-B8).

Scale notes that apply throughout:

* calendar filters are turned into a month and ``date_key`` range on the fact
  (``in_range``), so the scan opens only those months' directories and skips
  row groups inside them;
* Q4, Q5, V3, V9, B3, B4 and everything through the semantic API aggregate the
  fact to its foreign keys *before* joining a dimension; Q1-Q3, Q6-Q8 and B6
  join the routes or dates first, since they filter or group by them;
* results are ordered only where a consumer shows them in an order, and every
  order ends in a key that makes it unique.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecast.functions import classifiers as C
from routecast.functions.mathcols import avg_exact, rate
from routecast.plans.semantic import OPERATIONS, PUNCTUALITY, Between, semantic_query
from routecast.plans.warehouse import Warehouse
from routecast.sources.calendar import in_period, last_full_quarter


@dataclass(frozen=True)
class Params:
    """Parameters of the registered queries (FIXTURES.md §2 binding)."""

    year: int = 1996
    season: str = "Summer"
    quarter: int = 2
    route_name: str = "EUROPE - NATION_3"
    compare_routes: tuple[str, ...] = ("AMERICA - NATION_1", "EUROPE - NATION_3")
    underperforming_occupancy: float = 0.5
    drill_route_id: str = "RT003"


P = Params()


def pct1_of_avg(total: Column, count: Column) -> Column:
    """round(avg * 100, 1) of a decimal column from its exact sum and count:
    decimal division, so a tie such as 0.1455 -> 14.55 rounds up as in the
    source dialect (the double 14.549999... would round down)."""
    return F.round(total * F.lit(100) / F.when(count != 0, count).cast("decimal(20,0)"), 1).cast("double")


def pct1_avg(col: str) -> Column:
    return pct1_of_avg(F.sum(col), F.count(col))


def money(x: Column) -> Column:
    return F.round(x, 2).cast("decimal(38,2)")


def date_range(year: int, quarter: int | None = None, months: tuple[int, int] | None = None) -> tuple[dt.date, dt.date]:
    """[start, end) of a year, a quarter or a month span of a year."""
    if quarter is not None:
        start, end = dt.date(year, 3 * quarter - 2, 1), (dt.date(year + 1, 1, 1) if quarter == 4 else dt.date(year, 3 * quarter + 1, 1))
        return start, end
    if months is not None:
        return dt.date(year, months[0], 1), dt.date(year, months[1] + 1, 1) if months[1] < 12 else dt.date(year + 1, 1, 1)
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def in_range(rng: tuple[dt.date, dt.date]) -> Column:
    return in_period(*rng)


def dates(wh: Warehouse, cond: Column | None = None, cols: tuple[str, ...] = ()) -> DataFrame:
    """The filtered date dimension."""
    d = wh.dim_date if cond is None else wh.dim_date.filter(cond)
    return d.select("date_key", *cols)


def routes(wh: Warehouse, cols: tuple[str, ...] = ("route_name",)) -> DataFrame:
    return wh.dim_routes.select("route_id", *cols)


# --- Q1-Q8 (verified operations questions) -----------------------------------
def q1_season_occupancy(wh: Warehouse, p: Params = P) -> DataFrame:
    """Avg occupancy for one route in a season of a year."""
    t = wh.fct_trips.filter(in_range(date_range(p.year)))
    d = dates(wh, (F.col("season") == p.season) & (F.col("year") == p.year), ("season",))
    r = routes(wh).filter(F.col("route_name") == p.route_name)
    j = t.join(r, "route_id").join(d, "date_key")
    return j.groupBy("route_name", "season").agg(
        pct1_avg("occupancy_rate").alias("avg_occupancy_pct"),
        F.count("trip_id").alias("trip_count"),
    )


def q2_revenue_by_route_quarter(wh: Warehouse, p: Params = P) -> DataFrame:
    rng = date_range(p.year, p.quarter)
    rev = wh.fct_revenue.filter(in_range(rng))
    d = dates(wh, (F.col("quarter") == p.quarter) & (F.col("year") == p.year), ("year_quarter",))
    j = rev.join(routes(wh), "route_id").join(d, "date_key")
    return j.groupBy("route_name", "year_quarter").agg(
        money(F.sum("total_fare")).alias("total_revenue"),
        F.count("booking_id").alias("booking_count"),
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "route_name", "year_quarter")


def _growth(q1: Column, q2: Column) -> Column:
    return F.round((q2.cast("double") - q1.cast("double")) / F.when(q1 != 0, q1).cast("double") * F.lit(100.0), 1)


def _avg_of(q: int) -> Column:
    n = F.col(f"q{q}_occ_n")
    return F.col(f"q{q}_occ_sum").cast("double") / F.when(n != 0, n).cast("double")


def q3_quarter_growth(wh: Warehouse, p: Params = P) -> DataFrame:
    """Q1 -> Q2 growth of revenue and occupancy per route (A11 pivot, J11)."""
    rng = date_range(p.year, months=(1, 6))
    d = dates(wh, (F.col("year") == p.year) & F.col("quarter").isin(1, 2), ("quarter",))
    r = routes(wh)
    qrev = (
        wh.fct_revenue.filter(in_range(rng)).join(r, "route_id").join(d, "date_key")
        .groupBy("route_name").pivot("quarter", [1, 2]).agg(F.sum("total_fare"))
        .select("route_name", F.col("1").alias("q1_revenue"), F.col("2").alias("q2_revenue"))
    )
    qocc = (
        wh.fct_trips.filter(in_range(rng)).join(r, "route_id").join(d, "date_key")
        .groupBy("route_name").pivot("quarter", [1, 2])
        .agg(F.sum("occupancy_rate").alias("s"), F.count("occupancy_rate").alias("n"))
        .select(
            "route_name",
            *[F.col(f"{q}_s").alias(f"q{q}_occ_sum") for q in (1, 2)],
            *[F.col(f"{q}_n").alias(f"q{q}_occ_n") for q in (1, 2)],
        )
    )
    j = qrev.join(qocc, "route_name")
    return j.select(
        "route_name",
        money(F.col("q1_revenue")).alias("q1_revenue"),
        money(F.col("q2_revenue")).alias("q2_revenue"),
        _growth(F.col("q1_revenue"), F.col("q2_revenue")).alias("revenue_growth_pct"),
        pct1_of_avg(F.col("q1_occ_sum"), F.col("q1_occ_n")).alias("q1_occupancy_pct"),
        pct1_of_avg(F.col("q2_occ_sum"), F.col("q2_occ_n")).alias("q2_occupancy_pct"),
        _growth(_avg_of(1), _avg_of(2)).alias("occupancy_growth_pct"),
    ).orderBy(F.col("revenue_growth_pct").desc_nulls_first(), "route_name")


def q4_occupancy_by_vehicle_type(wh: Warehouse, p: Params = P) -> DataFrame:
    """Pre-aggregate trips per vehicle, then join the (unbounded) vehicle
    dimension: the join sees one row per vehicle."""
    per_vehicle = wh.fct_trips.groupBy("vehicle_id").agg(
        F.sum("occupancy_rate").alias("s"), F.count("occupancy_rate").alias("n"), F.count("trip_id").alias("t")
    )
    v = wh.dim_vehicles.select("vehicle_id", "vehicle_type")
    j = per_vehicle.join(v, "vehicle_id")
    agg = j.groupBy("vehicle_type").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("t").alias("trip_count"))
    return agg.select(
        "vehicle_type",
        pct1_of_avg(F.col("s"), F.col("n")).alias("avg_occupancy_pct"),
        "trip_count",
    ).orderBy(F.col("avg_occupancy_pct").desc_nulls_first(), "vehicle_type")


def q5_revenue_per_passenger(wh: Warehouse, p: Params = P) -> DataFrame:
    rev = wh.fct_revenue.filter(F.col("booking_status") == "completed")
    per_route = rev.groupBy("route_id").agg(F.sum("total_fare").alias("f"), F.sum("passengers").alias("pax"))
    j = per_route.join(routes(wh), "route_id")
    agg = j.groupBy("route_name").agg(F.sum("f").alias("f"), F.sum("pax").alias("pax"))
    return agg.select(
        "route_name",
        F.round(F.col("f") / F.when(F.col("pax") != 0, F.col("pax")), 2).cast("double").alias("revenue_per_passenger"),
        F.col("pax").cast("long").alias("total_passengers"),
        money(F.col("f")).alias("total_revenue"),
    ).orderBy(F.col("revenue_per_passenger").desc_nulls_first(), "route_name")


def q6_underperforming_routes(wh: Warehouse, p: Params = P) -> DataFrame:
    """F8: HAVING avg(occupancy) < threshold."""
    j = wh.fct_trips.join(routes(wh, ("route_name", "vehicle_type")), "route_id")
    agg = j.groupBy("route_name", "vehicle_type").agg(
        avg_exact("occupancy_rate").alias("occ"),
        F.sum("occupancy_rate").alias("occ_s"),
        F.count("occupancy_rate").alias("occ_n"),
        F.avg("vehicle_capacity").alias("cap"),
        F.count("trip_id").alias("trip_count"),
    )
    return agg.filter(F.col("occ") < F.lit(p.underperforming_occupancy)).select(
        "route_name",
        "vehicle_type",
        pct1_of_avg(F.col("occ_s"), F.col("occ_n")).alias("avg_occupancy_pct"),
        F.round("cap", 0).alias("avg_capacity"),
        "trip_count",
    ).orderBy(F.col("avg_occupancy_pct").asc_nulls_last(), "route_name", "vehicle_type")


def q7_route_comparison(wh: Warehouse, p: Params = P) -> DataFrame:
    """IN-list of route names (values are parameters)."""
    rng = date_range(p.year, p.quarter)
    r = routes(wh).filter(F.col("route_name").isin(list(p.compare_routes)))
    d = dates(wh, (F.col("quarter") == p.quarter) & (F.col("year") == p.year))
    j = wh.fct_revenue.filter(in_range(rng)).join(r, "route_id").join(d, "date_key")
    return j.groupBy("route_name").agg(
        money(F.sum("total_fare")).alias("q2_revenue"),
        F.count("booking_id").alias("q2_bookings"),
        F.sum("passengers").cast("long").alias("q2_passengers"),
    ).orderBy(F.col("q2_revenue").desc_nulls_first(), "route_name")


def q8_occupancy_by_route_month(wh: Warehouse, p: Params = P) -> DataFrame:
    t = wh.fct_trips.filter(in_range(date_range(p.year)))
    d = dates(wh, F.col("year") == p.year, ("month_name", "month"))
    j = t.join(routes(wh), "route_id").join(d, "date_key")
    return j.groupBy("route_name", "month_name", "month").agg(
        pct1_avg("occupancy_rate").alias("avg_occupancy_pct"),
        F.count("trip_id").alias("trip_count"),
    ).orderBy("route_name", "month")


# --- V1-V10 (punctuality verified questions, through the semantic API) -------
def v1_otp_by_route(wh: Warehouse) -> DataFrame:
    return semantic_query(PUNCTUALITY, wh, ["route_name"], ["on_time_rate"], order_by=["route_name"])


def v2_avg_delay_by_route(wh: Warehouse) -> DataFrame:
    return semantic_query(
        PUNCTUALITY, wh, ["route_name"], ["avg_departure_delay"],
        order_by=[F.col("avg_departure_delay").desc_nulls_first(), "route_name"],
    )


def v3_common_delay_categories(wh: Warehouse) -> DataFrame:
    """Trips per primary delay category (J10 on the surrogate key)."""
    per_key = (
        wh.fct_punctuality.filter(F.col("delay_category_key").isNotNull())
        .groupBy("delay_category_key")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )
    dim = wh.dim_delay_categories.select("delay_category_key", "delay_category", "delay_domain")
    return per_key.join(dim, "delay_category_key").select(
        "delay_category", "delay_domain", "trip_count"
    ).orderBy(F.col("trip_count").desc_nulls_first(), "delay_category")


def v4_sla_breach_by_month_route(wh: Warehouse) -> DataFrame:
    return semantic_query(PUNCTUALITY, wh, ["route_name", "month", "month_name"], ["sla_breach_rate"])


def v5_punctuality_by_vehicle_type(wh: Warehouse) -> DataFrame:
    return semantic_query(
        PUNCTUALITY, wh, ["vehicle_type"], ["on_time_rate", "avg_departure_delay", "delayed_trip_count"]
    )


def v6_delay_cost_by_quarter(wh: Warehouse) -> DataFrame:
    return semantic_query(PUNCTUALITY, wh, ["year_quarter"], ["total_delay_cost"])


def v7_weekend_vs_weekday(wh: Warehouse) -> DataFrame:
    return semantic_query(PUNCTUALITY, wh, ["is_weekday"], ["on_time_rate", "delayed_trip_count"])


def v8_cascading_by_route(wh: Warehouse) -> DataFrame:
    return semantic_query(
        PUNCTUALITY, wh, ["route_name"], ["cascade_rate"], order_by=[F.col("cascade_rate").desc_nulls_first(), "route_name"]
    )


def v9_severity_by_route(wh: Warehouse) -> DataFrame:
    per = wh.fct_punctuality.groupBy("route_id", "delay_severity").agg(F.count(F.lit(1)).alias("trip_count"))
    return per.join(routes(wh), "route_id").select("route_name", "delay_severity", "trip_count")


def v10_risk_by_time_of_day(wh: Warehouse) -> DataFrame:
    return semantic_query(PUNCTUALITY, wh, ["departure_window"], ["avg_delay_risk_score"])


# --- B1-B8 (dashboards) -------------------------------------------------------
def _route_filter(df: DataFrame, route_ids: list[str] | None) -> DataFrame:
    return df if route_ids is None else df.filter(F.col("route_id").isin(route_ids))


def b1_punctuality_kpis(wh: Warehouse, route_ids: list[str] | None = None) -> DataFrame:
    f = _route_filter(wh.fct_punctuality, route_ids)
    return f.agg(
        F.count(F.lit(1)).alias("total_trips"),
        rate(F.col("is_on_time")).alias("otp_rate"),
        F.avg("departure_delay_minutes").alias("avg_delay"),
        F.sum("estimated_delay_cost_eur").cast("decimal(38,2)").alias("total_delay_cost"),
        rate(F.col("is_sla_breach")).alias("sla_breach_rate"),
    )


def b2_severity_distribution(wh: Warehouse, route_ids: list[str] | None = None, severities=None) -> DataFrame:
    f = _route_filter(wh.fct_punctuality, route_ids)
    sev = list(severities or C.DELAY_SEVERITY_ORDER)
    return (
        f.filter(F.col("delay_severity").isin(sev))
        .groupBy("delay_severity")
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy(F.col("trip_count").desc_nulls_first(), "delay_severity")
    )


def b3_otp_heatmap(wh: Warehouse, route_ids: list[str] | None = None) -> DataFrame:
    f = _route_filter(wh.fct_punctuality, route_ids)
    per = f.groupBy("route_id", "date_key").agg(F.count_if("is_on_time").alias("k"), F.count(F.lit(1)).alias("n"))
    d = dates(wh, None, ("month_name", "month"))
    j = per.join(routes(wh), "route_id").join(d, "date_key")
    agg = j.groupBy("route_name", "month_name", "month").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    return agg.select(
        "route_name", "month_name", "month",
        (F.col("k").cast("double") / F.col("n").cast("double") * F.lit(100.0)).alias("otp_pct"),
    ).orderBy("route_name", "month")


MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def b3_otp_heatmap_pivot(wh: Warehouse, route_ids: list[str] | None = None) -> DataFrame:
    """Route x month, months as columns in calendar order."""
    long = b3_otp_heatmap(wh, route_ids)
    return long.groupBy("route_name").pivot("month_name", MONTH_NAMES).agg(F.first("otp_pct"))


def b4_category_breakdown(wh: Warehouse, route_id: str = P.drill_route_id) -> DataFrame:
    per_key = (
        wh.fct_punctuality.filter((F.col("route_id") == route_id) & F.col("primary_delay_category").isNotNull())
        .groupBy("delay_category_key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("departure_delay_minutes").alias("s"), F.count("departure_delay_minutes").alias("c"))
    )
    dim = wh.dim_delay_categories.select("delay_category_key", "delay_category", "delay_domain", "controllability")
    j = per_key.join(dim, "delay_category_key")
    agg = j.groupBy("delay_category", "delay_domain", "controllability").agg(
        F.sum("n").alias("incident_trips"), F.sum("s").alias("s"), F.sum("c").alias("c")
    )
    return agg.select(
        "delay_category", "delay_domain", "controllability", "incident_trips",
        (F.col("s").cast("double") / F.when(F.col("c") != 0, F.col("c")).cast("double")).alias("avg_delay"),
    ).orderBy(F.col("incident_trips").desc_nulls_first(), "delay_category", "delay_domain")


def b5_route_key_metrics(wh: Warehouse, route_id: str = P.drill_route_id) -> DataFrame:
    f = wh.fct_punctuality.filter(F.col("route_id") == route_id)
    return f.agg(
        (rate(F.col("is_on_time")) * F.lit(100.0)).alias("otp_pct"),
        F.avg("departure_delay_minutes").alias("avg_dep_delay"),
        (rate(F.col("is_sla_breach")) * F.lit(100.0)).alias("sla_breach_pct"),
        (rate(F.col("has_cascading_incident")) * F.lit(100.0)).alias("cascade_pct"),
        F.sum("estimated_delay_cost_eur").cast("decimal(38,2)").alias("total_cost"),
        F.avg("delay_risk_score").alias("avg_risk_score"),
    )


def b6_monthly_delay_trend(wh: Warehouse, route_id: str = P.drill_route_id) -> DataFrame:
    f = wh.fct_punctuality.filter(F.col("route_id") == route_id)
    d = dates(wh, None, ("year", "month", "month_name"))
    j = f.join(d, "date_key")
    agg = j.groupBy("year", "month", "month_name").agg(
        F.avg("departure_delay_minutes").alias("avg_delay"),
        (rate(F.col("is_on_time")) * F.lit(100.0)).alias("otp_pct"),
    )
    return agg.select(
        F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("year_month"),
        "month_name", "avg_delay", "otp_pct",
    ).orderBy("year_month")


def b7_operations_kpis(wh: Warehouse) -> DataFrame:
    """M3 without dimensions: metrics of two facts side by side."""
    return semantic_query(
        OPERATIONS, wh, [], ["total_revenue", "average_occupancy_rate", "trip_count", "revenue_per_passenger"]
    )


def b7_revenue_by_quarter(wh: Warehouse, quarters: list[str] | None = None) -> DataFrame:
    filters = {"year_quarter": quarters} if quarters else {}
    return semantic_query(OPERATIONS, wh, ["year_quarter"], ["total_revenue"], filters=filters, order_by=["year_quarter"])


def b7_occupancy_by_route(wh: Warehouse, route_names: list[str] | None = None) -> DataFrame:
    filters = {"route_name": route_names} if route_names else {}
    return semantic_query(
        OPERATIONS, wh, ["route_name"], ["average_occupancy_rate"], filters=filters,
        order_by=[F.col("average_occupancy_rate").desc_nulls_first(), "route_name"],
    )


def b7_route_performance(wh: Warehouse, route_names: list[str] | None = None) -> DataFrame:
    filters = {"route_name": route_names} if route_names else {}
    return semantic_query(
        OPERATIONS, wh, ["route_name"],
        ["total_revenue", "average_occupancy_rate", "trip_count", "revenue_per_passenger", "booking_count"],
        filters=filters, order_by=[F.col("total_revenue").desc_nulls_first(), "route_name"],
    )


def m5_filtered_route_performance(wh: Warehouse, p: Params = P) -> DataFrame:
    """M5: dimension filters (route IN-list, year) pushed into each fact
    branch before aggregation, then ordered."""
    return semantic_query(
        OPERATIONS, wh, ["route_name", "year_quarter"],
        ["total_revenue", "trip_count", "average_occupancy_rate"],
        filters={"route_name": list(p.compare_routes), "year": p.year},
        order_by=["route_name", "year_quarter"],
    )


def m1_delay_fact_rows(wh: Warehouse, p: Params = P) -> DataFrame:
    """M1 row-level facts: per-trip delay facts with route, quarter and the
    SLA threshold of the trip's delay category, for one route."""
    from routecast.plans.semantic import semantic_facts

    return semantic_facts(
        PUNCTUALITY, wh,
        ["departure_delay_minutes", "estimated_delay_cost_eur", "sla_threshold_minutes"],
        ["route_name", "year_quarter", "delay_category"],
        filters={"route_name": p.route_name},
    )


def m4_route_members(wh: Warehouse) -> DataFrame:
    return semantic_query(OPERATIONS, wh, ["route_name"])


def m4_quarter_members(wh: Warehouse) -> DataFrame:
    """The quarters of the date dimension, of which a dashboard offers a choice."""
    return semantic_query(OPERATIONS, wh, ["year_quarter"], order_by=["year_quarter"])


def m4_quarters_with_revenue(wh: Warehouse) -> DataFrame:
    """Quarters that carry revenue (members of the date dimension reached
    from the revenue fact)."""
    return semantic_query(OPERATIONS, wh, ["year_quarter"], ["booking_count"]).select("year_quarter")


def m4_route_quarters(wh: Warehouse) -> DataFrame:
    """Members of two tables: the (route, quarter) pairs in which something ran or was booked."""
    return semantic_query(OPERATIONS, wh, ["route_name", "year_quarter"])


def m4_minivan_routes(wh: Warehouse) -> DataFrame:
    """M9: members filtered by a renamed dimension that is not asked for."""
    return semantic_query(OPERATIONS, wh, ["route_name"], filters={"route_vehicle_type": "minivan"})


def m5_range_and_missing(wh: Warehouse) -> DataFrame:
    """M5 with a range and the missing member: short routes' trips without a delay category."""
    return semantic_query(
        PUNCTUALITY, wh, ["route_name"], ["avg_arrival_delay", "severe_delay_rate"],
        filters={"distance_km": Between(40, 80), "primary_delay_category": None},
    )


def m7_revenue_and_passengers(wh: Warehouse) -> DataFrame:
    """The two operations metrics that no dashboard shows."""
    return semantic_query(OPERATIONS, wh, ["route_name", "year"], ["completed_revenue", "total_passengers"])


def m8_delay_impact(wh: Warehouse) -> DataFrame:
    """The three punctuality metrics that no question asks for."""
    return semantic_query(
        PUNCTUALITY, wh, ["route_name", "year_quarter"],
        ["avg_arrival_delay", "total_passenger_delay_impact", "severe_delay_rate"],
    )


def b7_revenue_of_quarters(wh: Warehouse, p: Params = P) -> DataFrame:
    """B7 with quarters chosen: only those months of the fact are read."""
    return b7_revenue_by_quarter(wh, [f"{p.year}-Q{p.quarter}", f"{p.year}-Q{p.quarter + 1}"])


def b8_revenue_at_risk(wh: Warehouse, route_ids: list[str] | None = None, completed_only: bool = True) -> DataFrame:
    """J12 + C26: route dimension left-joined to two per-route aggregates."""
    pf = _route_filter(wh.fct_punctuality, route_ids)
    delay_costs = pf.groupBy("route_id").agg(
        F.sum("estimated_delay_cost_eur").alias("delay_cost"),
        (rate(F.col("is_on_time")) * F.lit(100.0)).alias("otp_pct"),
        F.count(F.lit(1)).alias("trip_count"),
    )
    rf = _route_filter(wh.fct_revenue, route_ids)
    if completed_only:
        rf = rf.filter(F.col("booking_status") == "completed")
    revenue = rf.groupBy("route_id").agg(F.sum("total_fare").alias("total_revenue"))
    r = _route_filter(wh.dim_routes.select("route_id", "route_name"), route_ids)
    j = r.join(delay_costs, "route_id", "left").join(revenue, "route_id", "left")
    ratio = F.when(
        F.col("total_revenue") > 0,
        F.round(F.col("delay_cost") / F.col("total_revenue") * F.lit(100), 2),
    ).otherwise(F.lit(0))
    return j.select(
        "route_name",
        F.coalesce("total_revenue", F.lit(0)).cast("decimal(38,2)").alias("revenue"),
        F.coalesce("delay_cost", F.lit(0)).cast("decimal(38,2)").alias("delay_cost"),
        ratio.cast("double").alias("risk_ratio_pct"),
        "otp_pct",
        "trip_count",
        C.risk_level("delay_cost", "total_revenue").alias("risk_level"),
    ).orderBy(F.col("risk_ratio_pct").desc_nulls_first(), "route_name")


def b8_portfolio_totals(wh: Warehouse, route_ids: list[str] | None = None) -> DataFrame:
    """Totals over the per-route result (one small global aggregate)."""
    per = b8_revenue_at_risk(wh, route_ids)
    agg = per.agg(
        F.sum("delay_cost").alias("total_delay_cost"),
        F.sum("revenue").alias("total_revenue"),
        F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL")).alias("high_risk_routes"),
        F.count(F.lit(1)).alias("route_count"),
    )
    return agg.select(
        F.col("total_delay_cost").cast("decimal(38,2)").alias("total_delay_cost"),
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        (
            F.col("total_delay_cost").cast("double")
            / F.greatest(F.col("total_revenue").cast("double"), F.lit(1.0))
            * F.lit(100.0)
        ).alias("portfolio_risk_ratio_pct"),
        "high_risk_routes",
        "route_count",
    )


NAMED_QUERIES = {
    "Q1_season_occupancy": q1_season_occupancy,
    "Q2_revenue_by_route_quarter": q2_revenue_by_route_quarter,
    "Q3_quarter_growth": q3_quarter_growth,
    "Q4_occupancy_by_vehicle_type": q4_occupancy_by_vehicle_type,
    "Q5_revenue_per_passenger": q5_revenue_per_passenger,
    "Q6_underperforming_routes": q6_underperforming_routes,
    "Q7_route_comparison": q7_route_comparison,
    "Q8_occupancy_by_route_month": q8_occupancy_by_route_month,
    "V1_otp_by_route": v1_otp_by_route,
    "V2_avg_delay_by_route": v2_avg_delay_by_route,
    "V3_common_delay_categories": v3_common_delay_categories,
    "V4_sla_breach_by_month_route": v4_sla_breach_by_month_route,
    "V5_punctuality_by_vehicle_type": v5_punctuality_by_vehicle_type,
    "V6_delay_cost_by_quarter": v6_delay_cost_by_quarter,
    "V7_weekend_vs_weekday": v7_weekend_vs_weekday,
    "V8_cascading_by_route": v8_cascading_by_route,
    "V9_severity_by_route": v9_severity_by_route,
    "V10_risk_by_time_of_day": v10_risk_by_time_of_day,
    "B1_punctuality_kpis": b1_punctuality_kpis,
    "B2_severity_distribution": b2_severity_distribution,
    "B3_otp_heatmap": b3_otp_heatmap,
    "B3_otp_heatmap_pivot": b3_otp_heatmap_pivot,
    "B4_category_breakdown": b4_category_breakdown,
    "B5_route_key_metrics": b5_route_key_metrics,
    "B6_monthly_delay_trend": b6_monthly_delay_trend,
    "B7_operations_kpis": b7_operations_kpis,
    "B7_revenue_by_quarter": b7_revenue_by_quarter,
    "B7_occupancy_by_route": b7_occupancy_by_route,
    "B7_route_performance": b7_route_performance,
    "M5_filtered_route_performance": m5_filtered_route_performance,
    "M1_delay_fact_rows": m1_delay_fact_rows,
    "M4_route_members": m4_route_members,
    "M4_quarter_members": m4_quarter_members,
    "M4_quarters_with_revenue": m4_quarters_with_revenue,
    "M4_route_quarters": m4_route_quarters,
    "M4_minivan_routes": m4_minivan_routes,
    "M5_range_and_missing": m5_range_and_missing,
    "M7_revenue_and_passengers": m7_revenue_and_passengers,
    "M8_delay_impact": m8_delay_impact,
    "B7_revenue_of_quarters": b7_revenue_of_quarters,
    "B8_revenue_at_risk": b8_revenue_at_risk,
    "B8_portfolio_totals": b8_portfolio_totals,
}


# --- G1-G2 (reports), D1-D4 (data quality), X1-X2 (feedback) -----------------
# The whole range of the binding's dates, and the day a report is asked for:
# G1 and G2 over all years, and their default, the last full quarter before it.
ALL_YEARS = (dt.date(1995, 1, 1), dt.date(2025, 1, 1))
AS_OF = dt.date(2024, 8, 15)


def g1_route_report(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import route_report

    return route_report(wh, ALL_YEARS)


def g2_revenue_at_risk(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import revenue_at_risk

    return revenue_at_risk(wh, ALL_YEARS)


def g4_route_report_last_quarter(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import route_report

    return route_report(wh, last_full_quarter(AS_OF))


def g4_revenue_at_risk_last_quarter(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import revenue_at_risk

    return revenue_at_risk(wh, last_full_quarter(AS_OF))


def g2_portfolio(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import portfolio

    return portfolio(wh, ALL_YEARS)


def g2_actions(wh: Warehouse) -> DataFrame:
    from routecast.plans.reports import actions

    return actions(wh, ALL_YEARS)


def d1_duplicate_booking_ids(wh: Warehouse) -> DataFrame:
    from routecast.operators.quality import unique_failures

    return unique_failures(wh.stg_bookings, "booking_id")


def d2_incidents_without_trip(wh: Warehouse) -> DataFrame:
    """Staged incidents whose trip_id is NULL (the offending rows)."""
    from routecast.operators.quality import not_null_failures

    return not_null_failures(wh.stg_delay_incidents, "trip_id").select("incident_id", "trip_id", "route_id")


def d3_orphan_fact_vehicles(wh: Warehouse) -> DataFrame:
    from routecast.operators.quality import relationship_failures

    return relationship_failures(wh.fct_punctuality, "vehicle_id", wh.dim_vehicles, "vehicle_id").select(
        "trip_id", "vehicle_id"
    )


def d1_trips_with_several_incidents(wh: Warehouse) -> DataFrame:
    """D1 where it finds something: trips that more than one incident names."""
    from routecast.operators.quality import unique_failures

    return unique_failures(wh.stg_delay_incidents, "trip_id")


def d2_trips_without_category(wh: Warehouse) -> DataFrame:
    """D2 where it finds something: assessed trips without a delay category."""
    from routecast.operators.quality import not_null_failures

    return not_null_failures(wh.fct_punctuality, "primary_delay_category").select("trip_id", "route_id")


def d3_incidents_without_assessment(wh: Warehouse) -> DataFrame:
    """D3 where it finds something: incidents of trips that were not assessed
    (cancelled, or with an invalid schedule)."""
    from routecast.operators.quality import relationship_failures

    return relationship_failures(wh.stg_delay_incidents, "trip_id", wh.fct_punctuality, "trip_id").select("incident_id", "trip_id")


def d4_quarantined_incidents(wh: Warehouse) -> DataFrame:
    """Incidents that staging set aside, with the texts that did not parse."""
    return wh.quarantined_incidents


def d3_filtered_orphans(wh: Warehouse) -> DataFrame:
    """Incidents whose trip isn't in the fact, found behind a filter of the fact's keys."""
    from routecast.operators.quality import filtered_orphans

    return filtered_orphans(wh.stg_delay_incidents, "trip_id", wh.fct_punctuality, "trip_id").select("incident_id", "trip_id")


def d4_dq_summary(wh: Warehouse) -> DataFrame:
    from routecast.operators.quality import dq_summary

    return dq_summary(wh.tables())


def x1_negative_feedback(wh: Warehouse) -> DataFrame:
    from routecast.operators.feedback import feedback_records

    return feedback_records(wh.feedback, negative_only=True)


def x1_all_feedback(wh: Warehouse) -> DataFrame:
    """Every feedback record, without sign or limit."""
    from routecast.operators.feedback import feedback_records

    return feedback_records(wh.feedback)


def x1_recent_feedback(wh: Warehouse) -> DataFrame:
    """The monitoring view: newest 20 feedback records (the limit is the
    feature)."""
    from routecast.operators.feedback import feedback_records, newest_first

    return newest_first(feedback_records(wh.feedback), limit=20)


def x2_keyword_feedback(wh: Warehouse) -> DataFrame:
    from routecast.operators.feedback import feedback_records, with_keyword

    return with_keyword(feedback_records(wh.feedback, negative_only=True))


#: Payloads whose time in microseconds has this divisor are cut off in X1_event_reconciliation.
CUT_EVERY = 97


def x1_event_reconciliation(wh: Warehouse) -> DataFrame:
    """Events of which some payloads are cut off: typed and rejected rows, which add up to the input."""
    from routecast.operators.feedback import FEEDBACK_RECORD, rejected_events, typed_events

    cut = F.unix_micros(F.col("timestamp").cast("timestamp")) % CUT_EVERY == 0
    events = wh.feedback_events.withColumn("value", F.when(cut, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))
    kind = F.when(F.col("record_name") == FEEDBACK_RECORD, "feedback").otherwise("other record")
    typed = typed_events(events).groupBy(kind.alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("is_positive") == "false").alias("n_negative"))
    bad = rejected_events(events).groupBy(F.concat(F.lit("malformed: "), "malformed").alias("outcome"))
    return typed.unionByName(bad.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("n_negative")))


def p7_reconciliation(wh: Warehouse) -> DataFrame:
    """Rows read, kept, quarantined and left out by each rule, as the build has counted them."""
    from routecast.operators.reconciliation import as_table

    return as_table(wh.dim_routes.sparkSession, wh.reconciliation)


def m3_rollup_by_season(wh: Warehouse) -> DataFrame:
    """M2/M3 from the stored aggregates of both operations facts."""
    return semantic_query(
        OPERATIONS,
        wh,
        ["season", "origin"],
        ["total_revenue", "booking_count", "revenue_per_passenger", "trip_count", "average_occupancy_rate"],
        filters={"year": [1996, 1997]},
    )


NAMED_QUERIES.update(
    {
        "G1_route_report": g1_route_report,
        "G2_revenue_at_risk": g2_revenue_at_risk,
        "G2_portfolio": g2_portfolio,
        "G2_actions": g2_actions,
        "G4_route_report_last_quarter": g4_route_report_last_quarter,
        "G4_revenue_at_risk_last_quarter": g4_revenue_at_risk_last_quarter,
        "D1_duplicate_booking_ids": d1_duplicate_booking_ids,
        "D2_incidents_without_trip": d2_incidents_without_trip,
        "D3_orphan_fact_vehicles": d3_orphan_fact_vehicles,
        "D1_trips_with_several_incidents": d1_trips_with_several_incidents,
        "D2_trips_without_category": d2_trips_without_category,
        "D3_incidents_without_assessment": d3_incidents_without_assessment,
        "D4_quarantined_incidents": d4_quarantined_incidents,
        "D3_filtered_orphans": d3_filtered_orphans,
        "D4_dq_summary": d4_dq_summary,
        "M3_rollup_by_season": m3_rollup_by_season,
        "P7_reconciliation": p7_reconciliation,
        "X1_event_reconciliation": x1_event_reconciliation,
        "X1_all_feedback": x1_all_feedback,
        "X1_negative_feedback": x1_negative_feedback,
        "X1_recent_feedback": x1_recent_feedback,
        "X2_keyword_feedback": x2_keyword_feedback,
    }
)
