"""Facts (P6, J6-J8, A5, A6, C21-C24)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.functions import classifiers as C
from routecast.operators import order_statistics
from routecast.session import scratch_dir
from routecast.sources.calendar import month_key


# Every fact has ``month_key`` as its last column: the partition of its files.
FCT_TRIPS_COLUMNS = [
    "trip_id", "route_id", "vehicle_id", "date_key", "departure_at", "arrival_at",
    "vehicle_capacity", "passengers_onboard", "occupancy_rate", "trip_status",
]
FCT_REVENUE_COLUMNS = [
    "booking_id", "trip_id", "route_id", "date_key", "booked_at", "passengers", "fare_per_passenger",
    "total_fare", "payment_method", "booking_status", "channel",
]


def fct_trips(int_trip_occupancy: DataFrame) -> DataFrame:
    return int_trip_occupancy.select(
        "trip_id",
        "route_id",
        "vehicle_id",
        F.col("trip_date").cast("date").alias("date_key"),
        "departure_at",
        "arrival_at",
        "vehicle_capacity",
        "passengers_onboard",
        "occupancy_rate",
        "trip_status",
        month_key("trip_date").alias("month_key"),
    )


def fct_revenue(int_booking_revenue: DataFrame) -> DataFrame:
    return int_booking_revenue.select(
        "booking_id",
        "trip_id",
        "route_id",
        F.col("booking_date").cast("date").alias("date_key"),
        "booked_at",
        "passengers",
        "fare_per_passenger",
        "total_fare",
        "payment_method",
        "booking_status",
        "channel",
        month_key("booking_date").alias("month_key"),
    )


PERCENTILES = {"p50_departure_delay": 0.50, "p75_departure_delay": 0.75, "p90_departure_delay": 0.90, "p95_departure_delay": 0.95}
DELAY = "departure_delay_minutes"


def delay_counts(punctuality: DataFrame, *by: str) -> DataFrame:
    """How many trips of a route (and of ``by``) have a delay: all that the benchmarks need."""
    return order_statistics.value_counts(punctuality, ["route_id", *by], DELAY, "n_trips")


def _checkpoint(df: DataFrame) -> Callable[[DataFrame, str], DataFrame]:
    scratch_dir(df.sparkSession)  # names the folder of the checkpoints
    return lambda df, name: df.checkpoint()


def benchmarks_of_counts(counts: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """A5 + A6: exact interpolated percentiles, mean and sample stddev of the
    departure delay per route, from (route, delay) counts.

    ``stage`` writes a table and reads it back; without it, a checkpoint."""
    stage = stage or _checkpoint(counts)
    ranks = order_statistics.percentiles(counts, "route_id", DELAY, PERCENTILES, lambda df: stage(df, "delay_ranges"), "n_trips")
    spread = order_statistics.mean_and_spread(counts, "route_id", DELAY, "route_avg_departure_delay", "route_stddev_departure_delay", "n_trips")
    spread = spread.withColumnRenamed("route_id", "_route")
    return ranks.join(spread, F.col("route_id").eqNullSafe(F.col("_route"))).drop("_route")


def route_benchmarks(punctuality: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """:func:`benchmarks_of_counts` of the trips at hand."""
    stage = stage or _checkpoint(punctuality)
    return benchmarks_of_counts(stage(delay_counts(punctuality), "delay_counts"), stage)


FCT_PUNCTUALITY_COLUMNS = [
    "trip_id", "route_id", "vehicle_id", "date_key", "route_name", "vehicle_type", "service_type",
    "departure_window", "is_weekend_service", "schedule_density", "scheduled_departure_at",
    "scheduled_arrival_at", "scheduled_duration_minutes", "actual_departure_at", "actual_arrival_at",
    "actual_duration_minutes", "departure_delay_minutes", "arrival_delay_minutes", "travel_time_ratio",
    "is_on_time_departure", "is_on_time_arrival", "is_on_time", "delay_severity", "incident_count",
    "total_incident_delay_minutes", "max_single_delay_minutes", "total_passenger_delay_minutes",
    "delay_categories", "delay_domains", "has_cascading_incident", "incident_worst_severity",
    "vehicle_rolling_avg_delay_5trips", "is_probable_cascade", "vehicle_turnaround_minutes",
    "delay_risk_score", "passengers_onboard", "primary_delay_category", "delay_category_key",
    "delay_controllability", "sla_threshold_minutes", "is_sla_breach", "route_p50_delay",
    "route_p75_delay", "route_p90_delay", "route_avg_departure_delay", "route_delay_percentile_band",
    "delay_z_score", "estimated_delay_cost_eur",
]


#: Columns of the fact that depend on all trips of the route, not on the trip alone.
ROUTE_STATISTICS = [
    "route_p50_delay", "route_p75_delay", "route_p90_delay", "route_avg_departure_delay", "route_delay_percentile_band", "delay_z_score",
]


def trip_facts(punctuality: DataFrame) -> DataFrame:
    """The fact's columns that the trip's own row decides, and ``month_key``.

    J6/J7: the primary (worst) incident category comes from the incident
    rollup, already joined on ``trip_id``. The delay-category dimension is
    built from the same valid incidents and its attributes are pure
    functions of the category (C20), so the left lookup is evaluated in
    place: identical to joining ``dim_delay_categories`` (a category that
    is present always matches; NULL never does) without another exchange."""
    cat = F.col("primary_delay_category")
    has_cat = cat.isNotNull()
    sla = F.when(has_cat, C.sla_threshold_minutes(cat))
    made = {
        "date_key": F.col("trip_date").cast("date"),
        "delay_category_key": F.when(has_cat, F.md5(cat)),
        "delay_controllability": F.when(has_cat, C.controllability(C.delay_domain(cat))),
        "sla_threshold_minutes": sla,
        "is_sla_breach": C.sla_breach(cat, DELAY, sla),
        "estimated_delay_cost_eur": C.delay_cost_eur(DELAY, "passengers_onboard"),
    }
    own = [c for c in FCT_PUNCTUALITY_COLUMNS if c not in ROUTE_STATISTICS]
    return punctuality.select(*[made[c].alias(c) if c in made else F.col(c) for c in own], month_key("trip_date").alias("month_key"))


def with_route_statistics(facts: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """The benchmarks, one row per route, joined back; AQE broadcasts them from their real size."""
    bm = benchmarks.withColumnRenamed("route_id", "_bm_route_id")
    j = facts.join(bm, facts["route_id"] == bm["_bm_route_id"], "left")
    p50, p75, p90 = "p50_departure_delay", "p75_departure_delay", "p90_departure_delay"
    made = {
        "route_p50_delay": F.col(p50),
        "route_p75_delay": F.col(p75),
        "route_p90_delay": F.col(p90),
        "route_delay_percentile_band": C.percentile_band(DELAY, p50, p75, p90),
        "delay_z_score": C.z_score(DELAY, "route_avg_departure_delay", "route_stddev_departure_delay"),
    }
    return j.select(*[made[c].alias(c) if c in made else F.col(c) for c in FCT_PUNCTUALITY_COLUMNS], "month_key")


def fct_punctuality(punctuality: DataFrame, benchmarks: DataFrame | None = None) -> DataFrame:
    """One row per trip."""
    return with_route_statistics(trip_facts(punctuality), route_benchmarks(punctuality) if benchmarks is None else benchmarks)
