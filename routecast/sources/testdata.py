"""Binding of the driver's TPC-H-ish parquet tables to the six raw inputs.

This is test plumbing only: operators take DataFrames and never look at
these tables. The arithmetic is deterministic and is mirrored line by line
by the DuckDB oracle (``duckdb_oracle/prelude.py``), so both engines see
identical raw inputs. Rules (FIXTURES.md §2):

* routes   <- nation x region   (route_id = 'RT' + 3-digit nation key)
* vehicles <- customer
* operations trips <- orders x customer; bookings <- lineitem x orders x customer
* punctuality trips, schedules and incidents <- events (x customer)
* feedback events <- events

Operations and punctuality use separate trip sets (orders span 1995-2001
with midnight timestamps; events have dense sub-second times in January
2024, and are spread over that year here); they share routes and vehicles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.functions.timecols import add_minutes, add_seconds
from routecast.sources.schemas import RawInputs

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


BOUND_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def route_key(n: Column) -> Column:
    return F.concat(F.lit("RT"), F.lpad(n.cast("string"), 3, "0"))


def _pick(idx: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr


# --- fixed values of the binding (mirrored by the oracle) -----------------
CHANNELS = ["website", "mobile_app", "partner_api"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "ideal", "bancontact"]
BOOKING_STATUSES = ["refunded", "no_show", "cancelled", "completed"]
SERVICE_TYPES_RAW = [" Regular", "EXPRESS ", "Peak_Hour"]
DELAY_CATEGORIES_RAW = [
    " Traffic_Congestion",
    "road_closure ",
    "WEATHER_CONDITIONS",
    "mechanical_issue",
    " Passenger_Boarding ",
    "security_check",
    "Operational_Handover",
    "other",
]
IMPACT_LEVELS_RAW = [" Low", "MEDIUM", "high "]
FEEDBACK_RECORD_NAME = "AGENT_FEEDBACK"
# Every event of a trip's group of three is moved by the same 0..11 steps of so many days.
SPREAD_DAYS = 28
# Incidents with these multiples of event_id have a fractional or an unreadable delay text.
FRACTION_EVERY, UNREADABLE_EVERY = 211, 499
# Days of dim_date: orders (1995-2001) and events (2024).
DATE_START, DATE_END = dt.date(1995, 1, 1), dt.date(2025, 1, 1)
# ---------------------------------------------------------------------------


def raw_routes(nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        route_key(k).alias("route_id"),
        F.concat_ws(" - ", "r_name", "n_name").alias("route_name"),
        F.col("r_name").alias("origin"),
        F.col("n_name").alias("destination"),
        (F.lit(40) + (k * 37) % 81).cast("int").alias("distance_km"),
        F.when(k % 3 == 0, "minivan").otherwise("shuttle_bus").alias("vehicle_type"),
        (F.lit(10) + k % 20).cast("decimal(18,2)").alias("base_fare_eur"),
        (F.lit(3) + k % 6).cast("int").alias("frequency_daily"),
    )


def _vehicle_attrs(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    minivan = F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE")
    return customer.select(
        k.alias("_custkey"),
        F.col("c_nationkey").alias("_nationkey"),
        F.when(minivan, "minivan").otherwise("shuttle_bus").alias("_vehicle_type"),
        F.when(minivan, F.lit(8) + (k % 2) * 4).otherwise(F.lit(40) + (k % 4) * 5).cast("int").alias("_capacity"),
    )


def raw_vehicles(customer: DataFrame) -> DataFrame:
    v = _vehicle_attrs(customer)
    k = F.col("_custkey")
    return v.select(
        k.cast("string").alias("vehicle_id"),
        F.col("_vehicle_type").alias("vehicle_type"),
        F.col("_capacity").alias("capacity"),
        F.concat(F.lit("REG-"), F.lpad(k.cast("string"), 7, "0")).alias("registration_plate"),
        (F.lit(2020) + k % 5).cast("int").alias("year_manufactured"),
        F.lit("active").alias("status"),
    )


def raw_trips(orders: DataFrame, customer: DataFrame) -> DataFrame:
    v = _vehicle_attrs(customer)
    k = F.col("o_orderkey")
    dep = add_seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    return orders.join(v, F.col("o_custkey") == F.col("_custkey")).select(
        k.cast("string").alias("trip_id"),
        route_key(F.col("_nationkey")).alias("route_id"),
        F.col("o_custkey").cast("string").alias("vehicle_id"),
        dep.alias("departure_datetime"),
        add_minutes(dep, F.lit(30) + k % 61).alias("arrival_datetime"),
        F.col("_capacity").alias("vehicle_capacity"),
        ((k * 31) % (F.col("_capacity") + 1)).cast("int").alias("passengers_onboard"),
        F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("completed").alias("trip_status"),
    )


#: Stand for NULL in a packed item: no line number (an int) and no passengers (-2 to 4, plus 2) have these values.
_NO_LINE, _NO_PAX = 1 << 31, 7


def packed_item(line: Column, pax: Column, status: Column) -> Column:
    """A line number, passengers (-2 to 4) and a status (0 to 3) as one long, NULLs told apart."""
    return F.coalesce(line.cast("long"), F.lit(_NO_LINE)) * 32 + F.coalesce(pax + 2, F.lit(_NO_PAX)) * 4 + status


def unpacked_item(packed: Column) -> tuple[Column, Column, Column]:
    line, pax = F.shiftright(packed, 5), F.shiftright(packed, 2).bitwiseAND(F.lit(7))
    return (
        F.when(line != _NO_LINE, line).try_cast("int"),
        F.when(pax != _NO_PAX, pax - 2).cast("int"),
        packed.bitwiseAND(F.lit(3)).cast("int"),
    )


def raw_bookings(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    cust = customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    ords = orders.select("o_orderkey", "o_custkey")
    status = (
        F.when(F.col("l_returnflag") == "R", 0)
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), 1)
        .when(F.col("l_returnflag") == "A", 2)
        .otherwise(3)
    )
    # Small numbers move to the join, three of them in one, and texts are made of them behind it.
    items = lineitem.select(
        "l_orderkey",
        packed_item(F.col("l_linenumber"), (F.lit(1) + F.col("l_quantity").cast("int") % 4).cast("int"), status).alias("_packed"),
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("_fare"),
        "l_shipdate",
    )
    ln, pax, status = unpacked_item(F.col("_packed"))
    fare = F.col("_fare")
    return (
        # The narrow sides meet first: line items move once.
        items.join(ords.join(cust, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", ln, "l_partkey", "l_suppkey").alias("booking_id"),
            F.col("l_orderkey").cast("string").alias("trip_id"),
            route_key(F.col("c_nationkey")).alias("route_id"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("booking_datetime"),
            pax.alias("passengers"),
            fare.alias("fare_per_passenger"),
            (fare * pax).cast("decimal(18,2)").alias("total_fare"),
            _pick(ln % 5, PAYMENT_METHODS).alias("payment_method"),
            _pick(status, BOOKING_STATUSES).alias("booking_status"),
            _pick(ln % 3, CHANNELS).alias("channel"),
        )
    )


def _spread(ts: str = "ts") -> Column:
    """The event's time, moved so that the events cover the whole year."""
    return F.timestamp_add("DAY", F.expr(f"event_id div 3 % 12 * {SPREAD_DAYS}"), F.col(ts).cast("timestamp_ntz"))


def raw_punctuality_trips(events: DataFrame, customer: DataFrame) -> DataFrame:
    v = _vehicle_attrs(customer)
    e = F.col("event_id")
    return events.join(v, F.col("user_id") == F.col("_custkey")).select(
        e.cast("string").alias("trip_id"),
        route_key(e % 25).alias("route_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        _spread().alias("departure_datetime"),
        add_minutes(_spread(), F.lit(30) + e % 61).alias("arrival_datetime"),
        F.col("_capacity").alias("vehicle_capacity"),
        ((e * 31) % (F.col("_capacity") + 1)).cast("int").alias("passengers_onboard"),
        F.when((F.col("event_type") == "view") & (e % 5 == 0), "cancelled")
        .otherwise("completed")
        .alias("trip_status"),
    )


def raw_scheduled_trips(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    dep = add_seconds(_spread(), F.lit(300) - F.floor(F.col("value") * 30).cast("long"))
    planned = F.lit(30) + e % 61 - e % 7
    return events.select(
        F.concat(F.lit("S"), e.cast("string")).alias("scheduled_trip_id"),
        e.cast("string").alias("trip_id"),
        route_key(e % 25).alias("route_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        dep.alias("scheduled_departure_at"),
        F.when(e % 97 == 0, dep).otherwise(add_minutes(dep, planned)).alias("scheduled_arrival_at"),
        _pick(e % 3, SERVICE_TYPES_RAW).alias("service_type"),
        F.concat(F.lit("2024-Q"), (F.lit(1) + e % 4).cast("string")).alias("schedule_version"),
    )


def raw_delay_incidents(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    trip = e - e % 3
    whole = F.floor(F.col("value")).cast("string")
    delay = (
        F.when(e % UNREADABLE_EVERY == 0, "n/a")
        .when(e % FRACTION_EVERY == 0, F.concat(whole, F.lit(".5")))
        .otherwise(whole)
    )
    return events.select(
        F.concat(F.lit("I"), e.cast("string")).alias("incident_id"),
        trip.cast("string").alias("trip_id"),
        route_key(trip % 25).alias("route_id"),
        _pick(e % 8, DELAY_CATEGORIES_RAW).alias("delay_category"),
        delay.alias("delay_minutes"),
        _pick(e % 3, IMPACT_LEVELS_RAW).alias("impact_level"),
        _spread().alias("reported_at"),
        add_minutes(_spread(), (e * 37) % 90 - 2).alias("resolved_at"),
        F.when(F.col("event_type") == "error", "true").otherwise("false").alias("is_cascading"),
        (F.col("user_id") % 50).cast("string").alias("affected_passengers"),
    )


def feedback_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def raw_feedback_events(events: DataFrame) -> DataFrame:
    """Observability events whose payloads are JSON text (dotted keys etc.)."""
    e = F.col("event_id")
    k = feedback_k(F.col("props"))
    name = F.when(e % 4 == 3, F.lit("AGENT_TRACE")).otherwise(F.lit(FEEDBACK_RECORD_NAME))
    message = F.when(
        k % 3 == 0, F.concat(F.lit("revenue looks wrong for route "), (e % 25).cast("string"))
    ).otherwise(F.concat(F.lit("answer ok "), k.cast("string")))
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.to_json(F.struct(name.alias("name"))).alias("record"),
        F.to_json(F.struct(F.col("user_id").cast("string").alias("user.name"))).alias(
            "resource_attributes"
        ),
        F.to_json(
            F.struct(
                F.array(F.col("event_type")).alias("categories"),
                message.alias("feedback_message"),
                (k % 2 == 0).alias("positive"),
            )
        ).alias("value"),
    )


def bind(spark: SparkSession, sf_dir: str) -> RawInputs:
    t = {name: read_table(spark, sf_dir, name) for name in BOUND_TABLES}
    return RawInputs(
        routes=raw_routes(t["nation"], t["region"]),
        vehicles=raw_vehicles(t["customer"]),
        trips=raw_trips(t["orders"], t["customer"]),
        bookings=raw_bookings(t["lineitem"], t["orders"], t["customer"]),
        punctuality_trips=raw_punctuality_trips(t["events"], t["customer"]),
        scheduled_trips=raw_scheduled_trips(t["events"]),
        delay_incidents=raw_delay_incidents(t["events"]),
        feedback_events=raw_feedback_events(t["events"]),
    )
