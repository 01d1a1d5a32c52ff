"""Whole-relation views of each layer, used as operator-level query keys."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.operators.intermediate import INT_PUNCTUALITY_COLUMNS
from routecast.operators.marts import FCT_PUNCTUALITY_COLUMNS, FCT_REVENUE_COLUMNS, FCT_TRIPS_COLUMNS
from routecast.plans import catalog, colocated
from routecast.plans.refresh import refresh_warehouse
from routecast.plans.warehouse import Warehouse
from routecast.session import scratch_dir
from routecast.sources import testdata
from routecast.sources.calendar import month_key
from routecast.sources.schemas import RAW_ROUTES
from routecast.sources.seeds import load_seed
from routecast.sources.sinks import read_table, register_views, remove_at_exit, write_table


def rollup_with_primary(wh: Warehouse) -> DataFrame:
    return wh.incident_rollup


def int_trip_punctuality(wh: Warehouse) -> DataFrame:
    return wh.int_trip_punctuality.select(*INT_PUNCTUALITY_COLUMNS)


def fct_punctuality(wh: Warehouse) -> DataFrame:
    return wh.fct_punctuality.select(*FCT_PUNCTUALITY_COLUMNS)


def fct_trips(wh: Warehouse) -> DataFrame:
    return wh.fct_trips.select(*FCT_TRIPS_COLUMNS)


def fct_revenue(wh: Warehouse) -> DataFrame:
    return wh.fct_revenue.select(*FCT_REVENUE_COLUMNS)


def dim_date_with_use(wh: Warehouse) -> DataFrame:
    """Every day of the spine, with the rows each fact has on it."""
    out = wh.dim_date
    for fact, name in ((wh.fct_trips, "trip_count"), (wh.fct_revenue, "booking_count"), (wh.fct_punctuality, "assessed_trip_count")):
        per_day = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias(name))
        out = out.join(per_day, "date_key", "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return out


def routes_view(wh: Warehouse) -> DataFrame:
    """S3: staging and marts as views, read back by SQL."""
    register_views({"v_dim_routes": wh.dim_routes, "v_fct_trips": wh.fct_trips})
    return wh.fct_trips.sparkSession.sql(
        "SELECT r.route_id, r.route_name, count(t.trip_id) AS trip_count "
        "FROM v_dim_routes r LEFT JOIN v_fct_trips t ON t.route_id = r.route_id GROUP BY r.route_id, r.route_name"
    )


def published_marts(wh: Warehouse) -> DataFrame:
    """The marts published in a catalog and read there by SQL, a year of trips by route and quarter."""
    spark = wh.dim_routes.sparkSession
    tag = uuid.uuid4().hex
    at = catalog.publish(wh, {layer: f"routecast_{layer}_{tag}" for layer in catalog.LAYERS}).views
    return spark.sql(f"""
        SELECT r.route_id, r.route_name, d.year_quarter, count(f.trip_id) AS trip_count, sum(f.passengers_onboard) AS passengers
        FROM {at["fct_trips"]} f JOIN {at["dim_date"]} d ON d.date_key = f.date_key LEFT JOIN {at["dim_routes"]} r ON r.route_id = f.route_id
        WHERE f.month_key BETWEEN 199601 AND 199612
        GROUP BY r.route_id, r.route_name, d.year_quarter""")


def seeded_routes(wh: Warehouse) -> DataFrame:
    """The routes through a CSV file with a header, as a seed is loaded."""
    spark = wh.dim_routes.sparkSession
    path = f"{scratch_dir(spark)}/seed-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    wh.stg_routes.write.option("header", True).csv(path)
    return load_seed(spark, path, RAW_ROUTES)


#: The month that the warehouse of :func:`refreshed_months` lacks before its refresh, of either trips.
LATE_TRIPS, LATE_PUNCTUALITY = 199603, 202405


def refreshed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse built without one month of trips, then refreshed with all of them.

    For each fact and month its rows, sums that the refresh has to get right,
    and whether the refresh wrote the month's files: the late month itself, and
    months in which a vehicle looks back into it."""
    raw = testdata.bind(spark, sf_dir)
    late = {"trips": LATE_TRIPS, "punctuality_trips": LATE_PUNCTUALITY}
    early = {n: getattr(raw, n).filter(~month_key("departure_datetime").eqNullSafe(F.lit(m))) for n, m in late.items()}
    store = f"{scratch_dir(spark)}/refreshed-{uuid.uuid4().hex}"
    remove_at_exit(spark, store)
    refresh_warehouse(spark, replace(raw, **early), store, testdata.DATE_START, testdata.DATE_END)
    done = refresh_warehouse(spark, raw, store, testdata.DATE_START, testdata.DATE_END)
    sums = {
        "fct_trips": (F.sum("passengers_onboard"), F.lit(0)),
        "fct_revenue": (F.sum("passengers"), F.lit(0)),
        "fct_punctuality": (F.sum("delay_risk_score"), F.sum(F.col("vehicle_turnaround_minutes"))),
    }
    parts = [
        getattr(done.warehouse, name)
        .groupBy("month_key")
        .agg(F.count(F.lit(1)).alias("n_rows"), a.cast("long").alias("sum_a"), b.cast("long").alias("sum_b"))
        .select(F.lit(name).alias("table_name"), "*", F.col("month_key").isin(done.written[name]).alias("is_rewritten"))
        for name, (a, b) in sums.items()
    ]
    return reduce(DataFrame.unionByName, parts)


#: Buckets of the layout below; a cluster's would be as many as its shuffle partitions.
BUCKETS = 16


def colocated_layout(wh: Warehouse) -> str:
    """Writes the bucketed trip tables of a warehouse; returns their database."""
    spark = wh.stg_routes.sparkSession
    database = f"routecast_{uuid.uuid4().hex}"
    root = f"{scratch_dir(spark)}/{database}"
    remove_at_exit(spark, root)
    colocated.write_layout(wh.stg_scheduled_trips, wh.stg_punctuality_trips, wh.stg_delay_incidents, database, root, BUCKETS)
    return database


def colocated_comparison(wh: Warehouse) -> DataFrame:
    """J3-J5 over buckets: no exchange of the three trip tables."""
    joined = colocated.comparison(wh.stg_routes.sparkSession, colocated_layout(wh), wh.stg_routes)
    return joined.select(*COMPARED_COLUMNS)


def colocated_punctuality(wh: Warehouse) -> DataFrame:
    """W5 over buckets: equal to ``W5_int_trip_punctuality``."""
    spark = wh.stg_routes.sparkSession
    database = colocated_layout(wh)
    root = f"{scratch_dir(spark)}/{database}_staged"
    remove_at_exit(spark, root)

    def stage(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{root}/{name}")
        return read_table(spark, f"{root}/{name}", df.schema)

    made = colocated.int_trip_punctuality(spark, database, wh.stg_routes, stage)
    return made.select(*INT_PUNCTUALITY_COLUMNS)


COMPARED_COLUMNS = [
    "scheduled_trip_id", "trip_id", "route_id", "route_name", "departure_delay_minutes", "arrival_delay_minutes", "incident_count",
    "total_incident_delay_minutes", "delay_categories", "delay_domains", "has_cascading_incident", "incident_worst_severity", "primary_delay_category",
]


def route_benchmarks_rounded(wh: Warehouse) -> DataFrame:
    """A5 + A6 per route (rounded to 9 dp so interpolation round-off of
    different engines compares equal)."""
    from routecast.operators.marts import route_benchmarks

    b = route_benchmarks(wh.int_trip_punctuality)
    return b.select(
        "route_id",
        *[F.round(c, 9).alias(c) for c in b.columns if c != "route_id"],
    )
