"""The raw inputs of a warehouse and their explicit schemas (no inference)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass
class RawInputs:
    """The raw relations (plus feedback events) that a warehouse is built from."""

    routes: DataFrame
    vehicles: DataFrame
    trips: DataFrame
    bookings: DataFrame
    punctuality_trips: DataFrame
    scheduled_trips: DataFrame
    delay_incidents: DataFrame
    feedback_events: DataFrame


RAW_ROUTES = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("route_name", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("distance_km", T.IntegerType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("base_fare_eur", T.DecimalType(18, 2)),
        T.StructField("frequency_daily", T.IntegerType()),
    ]
)

RAW_VEHICLES = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("registration_plate", T.StringType()),
        T.StructField("year_manufactured", T.IntegerType()),
        T.StructField("status", T.StringType()),
    ]
)

RAW_TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("departure_datetime", T.TimestampNTZType()),
        T.StructField("arrival_datetime", T.TimestampNTZType()),
        T.StructField("vehicle_capacity", T.IntegerType()),
        T.StructField("passengers_onboard", T.IntegerType()),
        T.StructField("trip_status", T.StringType()),
    ]
)

RAW_BOOKINGS = T.StructType(
    [
        T.StructField("booking_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("booking_datetime", T.TimestampNTZType()),
        T.StructField("passengers", T.IntegerType()),
        T.StructField("fare_per_passenger", T.DecimalType(18, 2)),
        T.StructField("total_fare", T.DecimalType(18, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("booking_status", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)

RAW_SCHEDULED_TRIPS = T.StructType(
    [
        T.StructField("scheduled_trip_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("scheduled_departure_at", T.TimestampNTZType()),
        T.StructField("scheduled_arrival_at", T.TimestampNTZType()),
        T.StructField("service_type", T.StringType()),
        T.StructField("schedule_version", T.StringType()),
    ]
)

# Free-text / dirty columns arrive as strings and are cast in staging.
RAW_DELAY_INCIDENTS = T.StructType(
    [
        T.StructField("incident_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("delay_category", T.StringType()),
        T.StructField("delay_minutes", T.StringType()),
        T.StructField("impact_level", T.StringType()),
        T.StructField("reported_at", T.TimestampNTZType()),
        T.StructField("resolved_at", T.TimestampNTZType()),
        T.StructField("is_cascading", T.StringType()),
        T.StructField("affected_passengers", T.StringType()),
    ]
)

FEEDBACK_EVENTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("record", T.StringType()),
        T.StructField("resource_attributes", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

RAW_SCHEMAS = {
    "raw_routes": RAW_ROUTES,
    "raw_vehicles": RAW_VEHICLES,
    "raw_trips": RAW_TRIPS,
    "raw_bookings": RAW_BOOKINGS,
    "raw_scheduled_trips": RAW_SCHEDULED_TRIPS,
    "raw_delay_incidents": RAW_DELAY_INCIDENTS,
}
