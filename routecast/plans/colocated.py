"""J3/J5 without an exchange: the three ``trip_id`` inputs kept in buckets.

Schedules, executed trips and the incident rollup are catalog tables of one
database, each written in the same number of buckets by ``trip_id`` and sorted
by it inside a bucket. A join of any of them on ``trip_id`` then reads bucket by
bucket: the rows that were shuffled once, when they were written, are not
shuffled again by any of the queries that join them.

All three have at most one row for a trip, so no bucket holds a hot key: the
incidents of a trip are rolled up before they are written. NULL trips join
nothing and are left out of the two sides of the inner join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.operators import intermediate
from routecast.sources import sinks

TABLES = ("scheduled_trips", "executed_trips", "incident_rollup")
KEY = "trip_id"


def write_layout(scheduled: DataFrame, trips: DataFrame, incidents: DataFrame, database: str, root: str, buckets: int) -> None:
    """Writes the three tables under ``root`` (a shared folder) and names them in ``database``.

    ``scheduled``, ``trips`` and ``incidents`` are staged. The tables hold what
    the join can use: valid schedules, completed trips, valid incidents.
    ``buckets`` should be so many that a bucket of the largest table fits a
    task; joined tables need the same number."""
    parts = {
        "scheduled_trips": scheduled.filter(F.col(KEY).isNotNull() & ~F.col("_is_invalid_schedule")),
        "executed_trips": trips.filter(F.col(KEY).isNotNull() & (F.col("trip_status") == "completed")),
        "incident_rollup": intermediate.incident_rollup(incidents),
    }
    scheduled.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}'")
    for name, df in parts.items():
        sinks.write_bucketed(df, f"`{database}`.`{name}`", f"{root.rstrip('/')}/{name}", KEY, buckets)


def joined_trips(spark: SparkSession, database: str, routes: DataFrame) -> DataFrame:
    """J3-J5 from the buckets: :func:`routecast.operators.intermediate.joined_trips` of them."""
    scheduled, trips, rollup = (spark.table(f"`{database}`.`{name}`") for name in TABLES)
    return intermediate.joined_trips(scheduled, trips, routes, rollup)


def comparison(spark: SparkSession, database: str, routes: DataFrame) -> DataFrame:
    """The joined trips with their delays and flags: :func:`routecast.operators.intermediate.flagged_comparison` of the buckets."""
    return intermediate.flagged(joined_trips(spark, database, routes))


def int_trip_punctuality(spark: SparkSession, database: str, routes: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The per-trip assessment (W1-W5) from the buckets. The joined trips are written, so the joins run once."""
    joined = stage(intermediate.numbered(joined_trips(spark, database, routes)), "int_trip_comparison")
    return intermediate.assessed_numbered(joined, stage)
