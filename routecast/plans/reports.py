"""Batch reports (G1-G4): the route report and revenue at risk for *all*
routes of a period, as Spark jobs.

Every input is first reduced to one row per route (partial + final
aggregates), so all later joins, pivots and windows work on tables bounded
by the number of routes. Fleet-wide values are one aggregate row that joins
every route. ``period`` is [start, end); ``calendar.last_full_quarter`` gives
the default period of a day, and None means all of the data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routecast.functions import classifiers as C
from routecast.functions.mathcols import dec, rate
from routecast.operators.windows import running_total
from routecast.plans.warehouse import Warehouse
from routecast.session import scratch_dir
from routecast.sources.calendar import in_period

Period = tuple[dt.date, dt.date]  # [start, end)


def months_in(period: Period) -> int:
    s, e = period
    return (e.year - s.year) * 12 + (e.month - s.month)


@dataclass(frozen=True)
class Thresholds:
    """G3 recommendation thresholds; the two vague ones are parameters."""

    otp_target: float = 0.80
    cost_share_of_revenue: float = 0.05
    low_occupancy: float = 0.50
    high_otp: float = 0.85
    high_cascade_rate: float = 0.30


def _in_period(df: DataFrame, period: Period | None) -> DataFrame:
    if period is None:
        return df
    return df.filter(in_period(*period))


def _ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.when(den != 0, den).cast("double")


def ops_by_route(wh: Warehouse, period: Period | None) -> DataFrame:
    trips = _in_period(wh.fct_trips, period).groupBy("route_id").agg(
        F.count("trip_id").alias("trip_count"),
        F.sum("passengers_onboard").cast("long").alias("total_passengers"),
        F.sum("occupancy_rate").alias("occ_sum"),
        F.count("occupancy_rate").alias("occ_n"),
    )
    rev = _in_period(wh.fct_revenue, period).groupBy("route_id").agg(
        F.sum("total_fare").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("passengers").cast("long").alias("booked_passengers"),
        F.count("booking_id").alias("booking_count"),
    )
    return trips.join(rev, "route_id", "full")


def punctuality_by_route(wh: Warehouse, period: Period | None) -> DataFrame:
    p = _in_period(wh.fct_punctuality, period)
    per = p.groupBy("route_id").agg(
        rate(F.col("is_on_time")).alias("on_time_rate"),
        F.avg("departure_delay_minutes").alias("avg_departure_delay"),
        rate(F.col("is_sla_breach")).alias("sla_breach_rate"),
        F.sum("estimated_delay_cost_eur").cast("decimal(38,2)").alias("total_delay_cost"),
        rate(F.col("has_cascading_incident")).alias("cascade_rate"),
        F.sum("total_passenger_delay_minutes").cast("long").alias("passenger_delay_minutes"),
        F.count_if(F.col("delay_severity").isin("major_delay", "severe_delay")).alias("severe_trip_count"),
        F.count(F.lit(1)).alias("punctuality_trips"),
        *[F.count_if(F.col("delay_severity") == s).alias(f"{s}_trips") for s in C.DELAY_SEVERITY_ORDER],
    )
    return per


def top_categories(wh: Warehouse, period: Period | None, n: int) -> DataFrame:
    """Per route, the ``n`` most frequent primary delay categories with trip
    count and average delay (ties: alphabetical), pivoted to columns."""
    p = _in_period(wh.fct_punctuality, period).filter(F.col("primary_delay_category").isNotNull())
    per = p.groupBy("route_id", "primary_delay_category").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("departure_delay_minutes").alias("avg_delay")
    )
    w = Window.partitionBy("route_id").orderBy(F.col("trips").desc(), F.col("primary_delay_category").asc())
    ranked = per.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= n)
    aggs = []
    for i in range(1, n + 1):
        hit = F.col("rk") == i
        aggs += [
            F.max(F.when(hit, F.col("primary_delay_category"))).alias(f"top{i}_category"),
            F.max(F.when(hit, F.col("trips"))).alias(f"top{i}_trips"),
            F.max(F.when(hit, F.col("avg_delay"))).alias(f"top{i}_avg_delay"),
        ]
    return ranked.groupBy("route_id").agg(*aggs)


def route_report(
    wh: Warehouse,
    period: Period | None,
    thresholds: Thresholds = Thresholds(),
    top_n: int = 3,
) -> DataFrame:
    """G1 + G3: one row per route with operations, fleet comparison,
    punctuality, severity counts, top delay categories and flags."""
    routes = wh.dim_routes.select("route_id", "route_name")
    ops = ops_by_route(wh, period)
    j = (
        routes.join(ops, "route_id", "left")
        .join(punctuality_by_route(wh, period), "route_id", "left")
        .join(top_categories(wh, period, top_n), "route_id", "left")
    )
    fleet = j.agg(
        F.sum("occ_sum").alias("_occ_sum"),
        F.sum("occ_n").alias("_occ_n"),
        F.sum("total_revenue").alias("_revenue"),
        F.sum("booked_passengers").alias("_booked"),
        F.sum("trip_count").alias("_trips"),
        F.sum("total_passengers").alias("_passengers"),
        F.count("trip_count").alias("_routes"),
    )
    j = j.join(F.broadcast(fleet))  # a global aggregate: exactly one row
    occ = _ratio(F.col("occ_sum"), F.col("occ_n"))
    fleet_occ = _ratio(F.col("_occ_sum"), F.col("_occ_n"))
    rpp = _ratio(F.col("total_revenue"), F.col("booked_passengers"))
    fleet_rpp = _ratio(F.col("_revenue"), F.col("_booked"))
    t = thresholds
    out = j.select(
        "route_id",
        "route_name",
        F.col("total_revenue"),
        rpp.alias("revenue_per_passenger"),
        occ.alias("average_occupancy_rate"),
        F.coalesce("trip_count", F.lit(0)).alias("trip_count"),
        F.coalesce("total_passengers", F.lit(0)).cast("long").alias("total_passengers"),
        fleet_occ.alias("fleet_average_occupancy_rate"),
        _ratio(F.col("_trips"), F.col("_routes")).alias("fleet_average_trip_count"),
        _ratio(F.col("_passengers"), F.col("_routes")).alias("fleet_average_passengers"),
        fleet_rpp.alias("fleet_revenue_per_passenger"),
        F.when(occ > fleet_occ, "above").when(occ < fleet_occ, "below").when(occ.isNotNull(), "equal").alias(
            "occupancy_vs_fleet"
        ),
        F.round((rpp - fleet_rpp) / F.when(fleet_rpp != 0, fleet_rpp) * F.lit(100.0), 1).alias(
            "revenue_per_passenger_vs_fleet_pct"
        ),
        "on_time_rate",
        "avg_departure_delay",
        "sla_breach_rate",
        "total_delay_cost",
        "cascade_rate",
        *[F.coalesce(f"{s}_trips", F.lit(0)).alias(f"{s}_trips") for s in C.DELAY_SEVERITY_ORDER],
        *[c for i in range(1, top_n + 1) for c in (f"top{i}_category", f"top{i}_trips", f"top{i}_avg_delay")],
        F.coalesce(F.col("on_time_rate") < t.otp_target, F.lit(False)).alias("flag_schedule_buffer"),
        F.coalesce(
            F.col("total_delay_cost") > F.col("total_revenue") * F.lit(t.cost_share_of_revenue).cast("decimal(10,4)"),
            F.lit(False),
        ).alias("flag_prioritize_top_category"),
        F.coalesce((occ < t.low_occupancy) & (F.col("on_time_rate") >= t.high_otp), F.lit(False)).alias(
            "flag_marketing_opportunity"
        ),
        F.coalesce(F.col("cascade_rate") > t.high_cascade_rate, F.lit(False)).alias("flag_turnaround_review"),
    )
    return out


def revenue_at_risk(
    wh: Warehouse,
    period: Period | None,
    months: int | None = None,
    completed_only: bool = False,
    churn_otp_target: float = 85.0,
    churn_rate_per_point: float = 0.02,
) -> DataFrame:
    """Delay cost against revenue per route, annualised, with churn
    risk, 50 % savings and the dominant delay category's mitigation; sorted
    by risk level (critical first) then ratio."""
    months = months or (months_in(period) if period else 12)
    p = punctuality_by_route(wh, period)
    rev_src = _in_period(wh.fct_revenue, period)
    if completed_only:
        rev_src = rev_src.filter(F.col("booking_status") == "completed")
    rev = rev_src.groupBy("route_id").agg(F.sum("total_fare").cast("decimal(38,2)").alias("total_revenue"))
    trips = _in_period(wh.fct_trips, period).groupBy("route_id").agg(
        F.count("trip_id").alias("trip_count"), F.sum("passengers_onboard").cast("long").alias("total_passengers")
    )
    dom = top_categories(wh, period, 1).select("route_id", F.col("top1_category").alias("dominant_delay_category"))
    j = (
        wh.dim_routes.select("route_id", "route_name")
        .join(p, "route_id", "left")
        .join(rev, "route_id", "left")
        .join(trips, "route_id", "left")
        .join(dom, "route_id", "left")
    )
    cost = F.col("total_delay_cost")
    revenue = F.col("total_revenue")
    otp_pct = F.col("on_time_rate") * F.lit(100.0)
    ratio_pct = _ratio(cost, revenue) * F.lit(100.0)
    level = C.risk_level(cost, revenue)
    base = j.select(
        "route_id",
        "route_name",
        revenue.alias("revenue"),
        cost.alias("delay_cost"),
        ratio_pct.alias("delay_cost_to_revenue_pct"),
        level.alias("risk_level"),
        otp_pct.alias("otp_pct"),
        "passenger_delay_minutes",
        "sla_breach_rate",
        F.coalesce("severe_trip_count", F.lit(0)).alias("severe_trip_count"),
        F.coalesce("trip_count", F.lit(0)).alias("trip_count"),
        F.coalesce("total_passengers", F.lit(0)).cast("long").alias("total_passengers"),
        (cost.cast("double") / F.lit(float(months)) * F.lit(12.0)).alias("annualized_delay_cost"),
        F.when(
            otp_pct < F.lit(churn_otp_target),
            revenue.cast("double") * F.lit(churn_rate_per_point) * (F.lit(churn_otp_target) - otp_pct),
        )
        .otherwise(F.lit(0.0))
        .alias("churn_risk_revenue"),
        (cost.cast("double") * F.lit(0.5)).alias("savings_if_halved"),
        "dominant_delay_category",
        F.when(F.col("dominant_delay_category").isNotNull(), C.mitigation_strategy("dominant_delay_category")).alias(
            "mitigation_strategy"
        ),
        C.risk_level_rank(level).alias("_level_rank"),
    )
    scratch_dir(base.sparkSession)  # names the folder of the checkpoint
    order = [F.col("_level_rank").asc(), F.col("delay_cost_to_revenue_pct").desc_nulls_last(), F.col("route_id").asc()]
    ranked = running_total(base, [], order, F.lit(1), "_before", "_routes", lambda df: df.checkpoint())
    return ranked.withColumn("exposure_rank", (F.col("_before") + 1).cast("int")).drop("_level_rank", "_before", "_routes").orderBy("exposure_rank")


def portfolio(wh: Warehouse, period: Period | None, top_n: int = 3, **options) -> DataFrame:
    """G2's findings over all routes: one row.

    Total delay cost, revenue and their ratio, the number of high and critical
    routes of all routes, the total annualised exposure and churn risk, and
    the ``top_n`` routes by exposure with category, mitigation and savings."""
    per = revenue_at_risk(wh, period, **options)
    first = F.struct(
        F.col("exposure_rank").alias("rank"), "route_name", "dominant_delay_category", "mitigation_strategy", "savings_if_halved"
    )
    # the ranks are 1..n, so a filter on them bounds the list
    top = F.array_sort(F.collect_list(F.when(F.col("exposure_rank") <= top_n, first)))
    return per.agg(
        F.sum("delay_cost").cast("decimal(38,2)").alias("total_delay_cost"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL")).alias("high_risk_routes"),
        F.count(F.lit(1)).alias("route_count"),
        top.alias("_top"),
        F.sum(F.col("delay_cost")).alias("_cost"),
    ).select(
        "total_delay_cost",
        "total_revenue",
        (_ratio(F.col("total_delay_cost"), F.col("total_revenue")) * F.lit(100.0)).alias("portfolio_ratio_pct"),
        "high_risk_routes",
        "route_count",
        (F.col("_cost").cast("double") / F.lit(float(options.get("months") or (months_in(period) if period else 12))) * F.lit(12.0)).alias(
            "total_annualized_exposure"
        ),
        *[F.get(F.col("_top"), i)["route_name"].alias(f"top{i + 1}_route") for i in range(top_n)],
        *[F.get(F.col("_top"), i)["mitigation_strategy"].alias(f"top{i + 1}_mitigation") for i in range(top_n)],
        *[F.get(F.col("_top"), i)["savings_if_halved"].alias(f"top{i + 1}_savings") for i in range(top_n)],
    )


#: Shares of revenue between which a route is watched: it nears the HIGH level.
WATCHED_SHARE = ("0.04", "0.05")
#: Domains whose delays the operator itself can act on.
CONTROLLABLE_DOMAINS = ("fleet", "internal_ops")


def actions(wh: Warehouse, period: Period | None, **options) -> DataFrame:
    """G2's recommended actions as flags: one row per route.

    ``act_now``: the level is critical. ``controllable_category``: the dominant
    category is of a domain the operator controls. ``watch``: the cost is
    above 4 % and at most 5 % of revenue, so the route nears the HIGH level
    ("approaching" is not quantified in the source; the lower end is ours)."""
    per = revenue_at_risk(wh, period, **options)
    cost, revenue = F.col("delay_cost").cast("decimal(30,2)"), F.col("revenue").cast("decimal(30,2)")
    low, high = (revenue * dec(x) for x in WATCHED_SHARE)
    return per.select(
        "route_id",
        "route_name",
        "exposure_rank",
        "risk_level",
        (F.col("risk_level") == "CRITICAL").alias("act_now"),
        F.coalesce(C.delay_domain("dominant_delay_category").isin(*CONTROLLABLE_DOMAINS), F.lit(False)).alias("controllable_category"),
        F.coalesce((revenue > 0) & (cost > low) & (cost <= high), F.lit(False)).alias("watch"),
    )
