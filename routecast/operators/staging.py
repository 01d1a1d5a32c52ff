"""Staging layer (P1-P8, C1-C13): one narrow projection per raw input.

Every function here is row-local (no shuffle), so Catalyst fuses it with the
scan into one whole-stage-codegen span and pushes later filters and column
pruning through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecast.functions import classifiers as C
from routecast.functions.timecols import minute_diff, ntz


def stg_routes(raw: DataFrame) -> DataFrame:
    """P1."""
    return raw.select(
        "route_id", "route_name", "origin", "destination", "distance_km",
        "vehicle_type", "base_fare_eur", "frequency_daily",
    )


def stg_vehicles(raw: DataFrame) -> DataFrame:
    """P2."""
    return raw.select("vehicle_id", "vehicle_type", "capacity", "registration_plate", "year_manufactured", "status")


def stg_trips(raw: DataFrame) -> DataFrame:
    """Typed timestamps, renamed."""
    return raw.select(
        "trip_id",
        "route_id",
        "vehicle_id",
        ntz("departure_datetime").alias("departure_at"),
        ntz("arrival_datetime").alias("arrival_at"),
        "vehicle_capacity",
        "passengers_onboard",
        "trip_status",
    )


def stg_bookings(raw: DataFrame) -> DataFrame:
    """P4."""
    return raw.select(
        "booking_id",
        "trip_id",
        "route_id",
        ntz("booking_datetime").alias("booked_at"),
        "passengers",
        "fare_per_passenger",
        "total_fare",
        "payment_method",
        "booking_status",
        "channel",
    )


def _typed_schedules(raw: DataFrame) -> DataFrame:
    """P7/P8, with the names of columns whose text does not parse in ``_unparsed``."""
    typed = raw.select(
        "scheduled_trip_id",
        "trip_id",
        "route_id",
        "vehicle_id",
        ntz("scheduled_departure_at").alias("scheduled_departure_at"),
        ntz("scheduled_arrival_at").alias("scheduled_arrival_at"),
        F.lower(F.trim("service_type")).alias("service_type"),
        "schedule_version",
        C.schedule_year("schedule_version").alias("schedule_year"),
    )
    return typed.withColumn("_unparsed", _unparsed({"schedule_version": ("schedule_version", "schedule_year")}))


def _unparsed(casts: dict[str, tuple[str, str]]) -> Column:
    """Names of the columns that have a text but no typed value, comma-joined."""
    return F.concat_ws(
        ",", *[F.when(F.col(text).isNotNull() & F.col(typed).isNull(), F.lit(name)) for name, (text, typed) in casts.items()]
    )


SCHEDULE_COLUMNS = [
    "scheduled_trip_id", "trip_id", "route_id", "vehicle_id",
    "scheduled_departure_at", "scheduled_arrival_at", "scheduled_duration_minutes",
    "service_type", "departure_window", "is_weekend_service", "schedule_density",
    "schedule_version", "schedule_quarter", "schedule_year", "_is_invalid_schedule",
]


def stg_scheduled_trips(raw: DataFrame) -> DataFrame:
    """P7/P8 + C1-C6: schedule metadata and the validity flag."""
    return read_schedules(raw).filter("_unparsed = ''").select(*SCHEDULE_COLUMNS)


def read_schedules(raw: DataFrame) -> DataFrame:
    """All schedules with their staged columns; ``_unparsed`` names the columns that don't parse."""
    typed = with_schedule_times(_typed_schedules(raw))
    enriched = typed.select(
        "*",
        C.schedule_quarter("schedule_version").alias("schedule_quarter"),
        C.invalid_schedule("scheduled_duration_minutes", F.col("scheduled_departure_at"), "scheduled_arrival_at").alias("_is_invalid_schedule"),
    )
    return enriched.select(*SCHEDULE_COLUMNS, "_unparsed")


def with_schedule_times(schedules: DataFrame) -> DataFrame:
    """What a schedule's departure and arrival say, row by row."""
    dep = F.col("scheduled_departure_at")
    return schedules.withColumn("scheduled_duration_minutes", minute_diff(dep, "scheduled_arrival_at")).select(
        "*",
        C.departure_window(dep).alias("departure_window"),
        C.is_weekend(dep).alias("is_weekend_service"),
        C.schedule_density(dep).alias("schedule_density"),
    )


def quarantined_schedules(raw: DataFrame) -> DataFrame:
    """Schedules that staging does not take, and why."""
    bad = _typed_schedules(raw).filter("_unparsed <> ''")
    return bad.select("scheduled_trip_id", "trip_id", "schedule_version", F.col("_unparsed").alias("unparsed_columns"))


def _typed_incidents(raw: DataFrame) -> DataFrame:
    """P7/P8, with the names of columns whose text does not parse in ``_unparsed``.

    Whole numbers go through an exact decimal and round half away from zero,
    as the source's integer cast does ("12.5" is 13)."""
    def whole(text: str) -> Column:
        return F.round(F.col(text).try_cast("decimal(28,8)"), 0).try_cast("int")

    typed = raw.select(
        "incident_id",
        "trip_id",
        "route_id",
        F.lower(F.trim("delay_category")).alias("delay_category"),
        whole("delay_minutes").alias("delay_minutes"),
        F.lower(F.trim("impact_level")).alias("impact_level"),
        ntz("reported_at").alias("reported_at"),
        ntz("resolved_at").alias("resolved_at"),
        F.col("is_cascading").try_cast("boolean").alias("is_cascading"),
        whole("affected_passengers").alias("affected_passengers"),
        F.col("delay_minutes").alias("_delay_text"),
        F.col("is_cascading").alias("_cascading_text"),
        F.col("affected_passengers").alias("_passengers_text"),
    )
    return typed.withColumn(
        "_unparsed",
        _unparsed(
            {
                "delay_minutes": ("_delay_text", "delay_minutes"),
                "is_cascading": ("_cascading_text", "is_cascading"),
                "affected_passengers": ("_passengers_text", "affected_passengers"),
            }
        ),
    )


INCIDENT_COLUMNS = [
    "incident_id", "trip_id", "route_id", "delay_category", "delay_domain", "delay_minutes",
    "impact_level", "computed_severity", "passenger_delay_minutes", "reported_at", "resolved_at",
    "resolution_minutes", "resolution_category", "incident_time_band", "is_cascading",
    "affected_passengers", "_is_rapid_resolution_anomaly", "_is_invalid_record",
]


def stg_delay_incidents(raw: DataFrame) -> DataFrame:
    """P7/P8 + C1, C7-C13. Text that does not parse neither fails the job nor
    becomes NULL: its row is in ``quarantined_incidents`` and not here."""
    return read_incidents(raw).filter("_unparsed = ''").select(*INCIDENT_COLUMNS)


def read_incidents(raw: DataFrame) -> DataFrame:
    """All incidents with their staged columns; ``_unparsed`` names the columns that don't parse."""
    typed = _typed_incidents(raw)
    # the boundary-minute difference is computed once and reused
    with_res = typed.withColumn("resolution_minutes", minute_diff("reported_at", "resolved_at"))
    enriched = with_res.select(
        "*",
        C.computed_severity("delay_minutes", "affected_passengers").alias("computed_severity"),
        (F.col("delay_minutes").cast("long") * F.col("affected_passengers")).alias("passenger_delay_minutes"),
        C.delay_domain("delay_category").alias("delay_domain"),
        C.resolution_category("resolution_minutes").alias("resolution_category"),
        C.incident_time_band("reported_at").alias("incident_time_band"),
        C.rapid_resolution_anomaly("resolution_minutes", "delay_minutes").alias("_is_rapid_resolution_anomaly"),
        C.invalid_incident("delay_minutes", "reported_at", "resolved_at").alias("_is_invalid_record"),
    )
    return enriched.select(*INCIDENT_COLUMNS, "_unparsed")


def quarantined_incidents(raw: DataFrame) -> DataFrame:
    """Incidents that staging does not take, with their texts, and why."""
    bad = _typed_incidents(raw).filter("_unparsed <> ''")
    return bad.select(
        "incident_id",
        "trip_id",
        F.col("_delay_text").alias("delay_minutes"),
        F.col("_cascading_text").alias("is_cascading"),
        F.col("_passengers_text").alias("affected_passengers"),
        F.col("_unparsed").alias("unparsed_columns"),
    )
