"""Intermediate layer.

Shuffle plan of ``int_trip_punctuality`` (at 1000x the test data):

* schedules, executed trips and the incident rollup all meet on
  ``trip_id``; the rollup ends hash-partitioned by it, so the three inputs
  move once for their joins, or not at all where they are kept in buckets
  (``plans.colocated``);
* routes are a dimension; Spark broadcasts them when their real size allows;
* the vehicle windows (W1-W3) and route-day windows (W4-W5) use the
  skew-safe operators in ``operators.windows``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routecast.functions import classifiers as C
from routecast.functions.timecols import minute_diff
from routecast.operators.staging import with_schedule_times
from routecast.session import scratch_dir
from routecast.operators.windows import lookback_window, rank_and_mean_by_group

ROUTE_COLS = ["route_id", "route_name", "origin", "destination"]


def int_trip_occupancy(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Completed trips with route names and occupancy."""
    r = routes.select(*ROUTE_COLS)
    t = trips.filter(F.col("trip_status") == "completed")
    return t.join(r, "route_id", "left").select(
        "trip_id",
        "route_id",
        "route_name",
        "origin",
        "destination",
        "vehicle_id",
        "departure_at",
        "arrival_at",
        "vehicle_capacity",
        "passengers_onboard",
        C.ratio_rounded("passengers_onboard", "vehicle_capacity", 4).alias("occupancy_rate"),
        "trip_status",
        F.col("departure_at").cast("date").alias("trip_date"),
    )


def int_booking_revenue(bookings: DataFrame, routes: DataFrame) -> DataFrame:
    """Bookings with route names."""
    r = routes.select(*ROUTE_COLS)
    return bookings.join(r, "route_id", "left").select(
        "booking_id",
        "trip_id",
        "route_id",
        "route_name",
        "origin",
        "destination",
        "booked_at",
        F.col("booked_at").cast("date").alias("booking_date"),
        "passengers",
        "fare_per_passenger",
        "total_fare",
        "payment_method",
        "booking_status",
        "channel",
    )


def valid_incidents(incidents: DataFrame) -> DataFrame:
    """F2."""
    return incidents.filter(~F.col("_is_invalid_record"))


def incident_partials(incidents: DataFrame) -> DataFrame:
    """A1, first level: one row for each (trip, category) of valid incidents.

    Counts, sums and extremes only, merged in each task before the shuffle: a
    trip with very many incidents sends at most a row for each category and task."""
    d = F.col("delay_minutes")
    severity = F.col("computed_severity")
    worst_first = F.struct(d.isNotNull().alias("k0"), (-d.cast("long")).alias("k1"), F.col("incident_id").alias("k2"), F.col("delay_category").alias("category"))
    return valid_incidents(incidents).groupBy("trip_id", "delay_category", "delay_domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(d).alias("late"),
        F.max(d).alias("longest"),
        F.sum("passenger_delay_minutes").alias("people_minutes"),
        F.max(F.when(F.col("is_cascading"), 1).otherwise(0)).alias("cascading"),
        F.max(severity).alias("last_severity"),
        F.max(F.struct(C.severity_rank(severity).alias("rank"), severity.alias("severity"))).alias("by_rank"),
        F.min(worst_first).alias("worst"),
    )


def incident_rollup(incidents: DataFrame) -> DataFrame:
    """A1 + A2 + W6: one row per trip from its valid incidents.

    Two levels: (trip, category) partials, then the trip's partials as one
    ordered frame, which holds a row for each category and no set of its
    incidents. The lists are in category and in domain order, without NULLs,
    and NULL if nothing is left.

    ``primary_delay_category`` is the category of the worst incident
    (largest delay, NULL delays first as in the source dialect, ties broken
    by the smallest ``incident_id``): the ``row_number() = 1`` of the
    reference, found in the same pass.
    """
    trip = Window.partitionBy("trip_id")
    whole = trip.orderBy("delay_category").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    listed = lambda a: F.when(F.size(a) > 0, F.array_join(a, ", "))
    framed = incident_partials(incidents).select(
        "trip_id",
        F.row_number().over(trip.orderBy("delay_category")).alias("_row"),
        F.sum("n").over(whole).alias("incident_count"),
        F.sum("late").over(whole).alias("total_incident_delay_minutes"),
        F.max("longest").over(whole).alias("max_single_delay_minutes"),
        F.sum("people_minutes").over(whole).alias("total_passenger_delay_minutes"),
        F.collect_list("delay_category").over(whole).alias("_categories"),
        F.collect_list("delay_domain").over(whole).alias("_domains"),
        F.max("cascading").over(whole).alias("has_cascading_incident"),
        # lexicographic, like the source: 'critical' loses to every other level
        F.max("last_severity").over(whole).alias("worst_severity"),
        # by rank, under a name of its own
        F.max("by_rank").over(whole).alias("_by_rank"),
        F.min("worst").over(whole).alias("_worst"),
    )
    return framed.filter("_row = 1").select(
        "trip_id",
        "incident_count",
        "total_incident_delay_minutes",
        "max_single_delay_minutes",
        "total_passenger_delay_minutes",
        listed(F.col("_categories")).alias("delay_categories"),
        listed(F.array_sort(F.array_distinct("_domains"))).alias("delay_domains"),
        "has_cascading_incident",
        "worst_severity",
        F.col("_by_rank.severity").alias("worst_severity_by_rank"),
        F.col("_worst.category").alias("primary_delay_category"),
    )


#: What a joined trip keeps of its schedule; the others are made of these, row by row.
SCHEDULE_OWN = ["scheduled_trip_id", "trip_id", "route_id", "vehicle_id", "scheduled_departure_at", "scheduled_arrival_at", "service_type"]


def met_trips(scheduled: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """J3 + J4: valid schedules with their completed trips and routes, in the columns that no others are made of."""
    s = scheduled.filter(~F.col("_is_invalid_schedule")).alias("s")
    a = (
        trips.filter(F.col("trip_status") == "completed")
        .select("trip_id", "departure_at", "arrival_at", "passengers_onboard")
        .alias("a")
    )
    r = routes.select("route_id", "route_name", "distance_km", "vehicle_type").alias("r")
    j = s.join(a, F.col("s.trip_id") == F.col("a.trip_id")).join(
        r, F.col("s.route_id") == F.col("r.route_id"), "left"
    )
    return j.select(
        *[f"s.{c}" for c in SCHEDULE_OWN],
        F.col("a.departure_at").alias("actual_departure_at"),
        F.col("a.arrival_at").alias("actual_arrival_at"),
        "a.passengers_onboard",
        "r.route_name",
        "r.distance_km",
        "r.vehicle_type",
    )


def with_delays(met: DataFrame) -> DataFrame:
    """C1-C4 + C15 on met trips, row by row."""
    actual_minutes = minute_diff("actual_departure_at", "actual_arrival_at")
    return with_schedule_times(met).select(
        "*",
        minute_diff("scheduled_departure_at", "actual_departure_at").alias("departure_delay_minutes"),
        minute_diff("scheduled_arrival_at", "actual_arrival_at").alias("arrival_delay_minutes"),
        actual_minutes.alias("actual_duration_minutes"),
        C.ratio_rounded(actual_minutes, "scheduled_duration_minutes", 3).alias("travel_time_ratio"),
        F.col("actual_departure_at").cast("date").alias("trip_date"),
    )


def trip_comparison(scheduled: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """J3 + J4 + C1 + C15: schedule vs execution, one row per trip."""
    return with_delays(met_trips(scheduled, trips, routes))


def with_incidents(tc: DataFrame, rollup: DataFrame) -> DataFrame:
    """Left join after the rollup; only counts and sums are zero-filled."""
    r = rollup.withColumnRenamed("trip_id", "_r_trip_id")
    j = tc.join(r, tc["trip_id"] == r["_r_trip_id"], "left")
    return j.select(
        *[tc[c] for c in tc.columns],
        F.coalesce("incident_count", F.lit(0)).alias("incident_count"),
        F.coalesce("total_incident_delay_minutes", F.lit(0)).alias("total_incident_delay_minutes"),
        "max_single_delay_minutes",
        F.coalesce("total_passenger_delay_minutes", F.lit(0)).alias("total_passenger_delay_minutes"),
        "delay_categories",
        "delay_domains",
        (F.coalesce("has_cascading_incident", F.lit(0)) == 1).alias("has_cascading_incident"),
        F.col("worst_severity").alias("incident_worst_severity"),
        F.col("worst_severity_by_rank").alias("incident_worst_severity_by_rank"),
        "primary_delay_category",
    )


#: W1-W3 look so many trips back, in this order of a vehicle's trips, at these columns.
LOOKBACK = 4
VEHICLE_ORDER = ["actual_departure_at", "trip_id"]
VEHICLE_CARRY = ["departure_delay_minutes", "actual_arrival_at"]


def vehicle_context(df: DataFrame, stage: Callable[[DataFrame], DataFrame], key: str | Sequence[str] = "vehicle_id") -> DataFrame:
    """Rolling 5-trip mean delay, previous delay and turnaround per
    vehicle, ordered by actual departure (trip_id breaks ties).

    ``key`` are the columns of the windows, if not the vehicle alone."""

    def cols(spec):
        return {
            "vehicle_rolling_avg_delay_5trips": F.avg("departure_delay_minutes").over(spec.rowsBetween(-LOOKBACK, 0)),
            "prev_trip_delay_minutes": F.lag("departure_delay_minutes", 1).over(spec),
            "vehicle_turnaround_minutes": minute_diff(
                F.lag("actual_arrival_at", 1).over(spec), F.col("actual_departure_at")
            ),
        }

    return lookback_window(
        df,
        key=key,
        order=VEHICLE_ORDER,
        depth=LOOKBACK,
        carry=VEHICLE_CARRY,
        columns=cols,
        stage=stage,
    )


def joined_trips(scheduled: DataFrame, trips: DataFrame, routes: DataFrame, rollup: DataFrame) -> DataFrame:
    """The rows that are moved and written; :func:`flagged` makes the other columns of them."""
    return with_incidents(met_trips(scheduled, trips, routes), rollup)


def flagged(joined: DataFrame) -> DataFrame:
    """Joined trips with their delays (C1-C4, C15) and the flags of these (C16, C17), row by row."""
    return with_delays(joined).select(
        "*",
        C.on_time("departure_delay_minutes").alias("is_on_time_departure"),
        C.on_time("arrival_delay_minutes").alias("is_on_time_arrival"),
        F.when(
            (F.col("departure_delay_minutes") <= 5) & (F.col("arrival_delay_minutes") <= 5), True
        ).otherwise(False).alias("is_on_time"),
        C.delay_severity("departure_delay_minutes").alias("delay_severity"),
    )


def flagged_comparison(scheduled: DataFrame, trips: DataFrame, routes: DataFrame, rollup: DataFrame) -> DataFrame:
    """J3-J5 with the flags of a trip's own delays."""
    return flagged(joined_trips(scheduled, trips, routes, rollup))


def route_day_context(vc: DataFrame) -> DataFrame:
    """W4, W5. ``vc`` is read twice."""
    return rank_and_mean_by_group(
        vc, ["route_id", "trip_date"], "departure_delay_minutes", "delay_rank_on_route_day", "route_day_avg_delay"
    )


def scored(rd: DataFrame) -> DataFrame:
    """C18 and C19 on trips that have the context of their vehicle and route-day."""
    final = rd.select(
        "*",
        C.probable_cascade("prev_trip_delay_minutes", "vehicle_turnaround_minutes").alias("is_probable_cascade"),
        C.delay_risk_score(
            "departure_delay_minutes",
            "is_on_time",
            "has_cascading_incident",
            "vehicle_rolling_avg_delay_5trips",
            "incident_count",
        ).alias("delay_risk_score"),
    )
    return final.select(*INT_PUNCTUALITY_COLUMNS, "primary_delay_category")


#: Number of a joined trip, any unique long.
ROW = "_row"
#: What the windows W1-W5 add to a joined trip.
CONTEXT = ["vehicle_rolling_avg_delay_5trips", "prev_trip_delay_minutes", "vehicle_turnaround_minutes", "delay_rank_on_route_day", "route_day_avg_delay"]


def numbered(joined: DataFrame) -> DataFrame:
    """Joined trips with a number each, to be written before they are read more than once:
    another run may number them in another way."""
    return joined.withColumn(ROW, F.monotonically_increasing_id())


#: What W1-W5 read of a joined trip, besides its number and its vehicle's order.
WINDOWED = ["route_id", "departure_delay_minutes", "actual_arrival_at"]


def windowed(joined: DataFrame, *more: str) -> DataFrame:
    """The few columns of joined trips that the windows W1-W5 move."""
    return flagged(joined).select(ROW, *more, "vehicle_id", *VEHICLE_ORDER, *WINDOWED)


def of_vehicles(context: DataFrame, *more: str) -> DataFrame:
    """What W4 and W5 need of trips that have their vehicle's context."""
    return context.select(ROW, *more, "route_id", F.col("actual_departure_at").cast("date").alias("trip_date"), "departure_delay_minutes", *CONTEXT[:3])


def assessed_numbered(joined: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """W1-W5, C18 and C19 on written, :func:`numbered` trips (:func:`joined_trips`).

    The windows move the few columns that they read; the joined rows move once,
    when they meet their context by number, and the columns that are made of
    them row by row are made after that. ``stage`` writes a table and reads it back."""
    of_vehicle = stage(of_vehicles(vehicle_context(windowed(joined), lambda df: stage(df, "int_trip_ranges"))), "int_vehicle_context")
    return scored(flagged(joined.join(route_day_context(of_vehicle).select(ROW, *CONTEXT), ROW)))


def int_trip_punctuality(
    scheduled: DataFrame,
    trips: DataFrame,
    incidents: DataFrame,
    routes: DataFrame,
    rollup: DataFrame | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The per-trip punctuality assessment (int_trip_punctuality).

    ``stage`` writes a table and reads it back. The joined trips are written
    first, numbered, so that the range exchange of W1-W3, which looks at its
    input twice, doesn't run the joins twice; then their window columns are
    dealt by vehicle and departure, and the window result is written for the
    route-day histogram and its join. Without ``stage`` these are checkpoints,
    in the same shared folder."""
    rollup = incident_rollup(incidents) if rollup is None else rollup
    joined = joined_trips(scheduled, trips, routes, rollup)
    if stage is None:
        scratch_dir(joined.sparkSession)  # names the folder of the checkpoints
        stage = lambda df, name: df.checkpoint()
    return assessed_numbered(stage(numbered(joined), "int_trip_comparison"), stage)


INT_PUNCTUALITY_COLUMNS = [
    "scheduled_trip_id", "trip_id", "route_id", "vehicle_id", "route_name", "distance_km",
    "vehicle_type", "service_type", "departure_window", "is_weekend_service", "schedule_density",
    "scheduled_departure_at", "scheduled_arrival_at", "scheduled_duration_minutes",
    "actual_departure_at", "actual_arrival_at", "actual_duration_minutes",
    "departure_delay_minutes", "arrival_delay_minutes", "travel_time_ratio",
    "is_on_time_departure", "is_on_time_arrival", "is_on_time", "delay_severity",
    "incident_count", "total_incident_delay_minutes", "max_single_delay_minutes",
    "total_passenger_delay_minutes", "delay_categories", "delay_domains",
    "has_cascading_incident", "incident_worst_severity", "vehicle_rolling_avg_delay_5trips",
    "prev_trip_delay_minutes", "vehicle_turnaround_minutes", "is_probable_cascade",
    "delay_rank_on_route_day", "route_day_avg_delay", "delay_risk_score",
    "passengers_onboard", "trip_date",
]
