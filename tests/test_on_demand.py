"""A build on demand writes what is read, and the narrow windows give whole rows."""

from __future__ import annotations

import uuid
from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from routecast.operators import intermediate
from routecast.plans import layers
from routecast.plans import queries as Q
from routecast.plans.warehouse import build_warehouse
from routecast.session import scratch_dir
from routecast.sources import testdata

SF = "/root/testdata/sf0.001"


def _fresh(spark, on_demand=True):
    store = f"{scratch_dir(spark)}/demand-{uuid.uuid4().hex}"
    wh = build_warehouse(spark, testdata.bind(spark, SF), testdata.DATE_START, testdata.DATE_END, store, on_demand=on_demand)
    return wh, Path(store.removeprefix("file:"))


def _written(store):
    return {p.name for layer in ("intermediate", "marts", "aggregates") for p in (store / layer).glob("*")}


def test_a_query_writes_only_the_tables_it_reads(spark):
    wh, store = _fresh(spark)
    assert layers.rollup_with_primary(wh).count() > 0 and Q.NAMED_QUERIES["X1_event_reconciliation"](wh).count() == 3
    assert _written(store) == set()
    Q.NAMED_QUERIES["Q6_underperforming_routes"](wh).collect()
    assert _written(store) == {"fct_trips", "dim_routes"}
    Q.NAMED_QUERIES["M3_rollup_by_season"](wh).collect()
    assert "fct_revenue" in _written(store) and "fct_punctuality" not in _written(store)


def test_delay_categories_write_the_punctuality_tables_alone(spark):
    wh, store = _fresh(spark)
    assert Q.NAMED_QUERIES["V3_common_delay_categories"](wh).count() > 0
    written = _written(store)
    assert {"fct_punctuality", "int_trip_punctuality", "dim_delay_categories"} <= written
    assert not {"fct_trips", "fct_revenue", "feedback"} & written and not list((store / "aggregates").glob("*"))


def test_each_table_is_made_once_and_equals_the_whole_build(spark, wh):
    got, store = _fresh(spark)
    assert got.fct_punctuality is got.fct_punctuality
    for name in ("fct_trips", "fct_revenue", "fct_punctuality", "int_trip_punctuality", "dim_delay_categories", "feedback"):
        a, b = getattr(got, name), getattr(wh, name).select(*getattr(got, name).columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert sorted(got.reconciliation) == sorted(wh.reconciliation)
    copy = replace(got, dim_date=got.dim_date.limit(1))
    assert copy.fct_trips is got.fct_trips and copy.dim_date.count() == 1


def test_a_whole_build_writes_all_tables(spark):
    wh, store = _fresh(spark, on_demand=False)
    assert {"fct_trips", "fct_revenue", "fct_punctuality", "feedback", "dim_date"} <= _written(store)
    assert len(wh.aggregates) == len(list((store / "aggregates").glob("*"))) > 0


def test_repeated_and_null_keys_keep_their_rows_and_rows_move_once(spark, wh):
    sched, trips = (getattr(wh, n).limit(300).union(getattr(wh, n).limit(40)).cache() for n in ("stg_scheduled_trips", "stg_punctuality_trips"))
    nulls = sched.limit(20).withColumn("vehicle_id", F.lit(None).cast("string")).withColumn("route_id", F.lit(None).cast("string"))
    sched = sched.union(nulls)
    joined = intermediate.flagged_comparison(sched, trips, wh.stg_routes, wh.incident_rollup)
    widths = {}

    def stage(df, name):
        widths[name] = len(df.columns)
        return df.checkpoint()

    got = intermediate.int_trip_punctuality(sched, trips, wh.stg_delay_incidents, wh.stg_routes, stage=stage)
    columns = ["scheduled_trip_id", "trip_id", "vehicle_id", "route_id", "departure_delay_minutes"]
    assert got.select(*columns).exceptAll(joined.select(*columns)).count() == 0
    assert joined.select(*columns).exceptAll(got.select(*columns)).count() == 0
    # only the columns that the windows read are dealt by vehicle
    assert widths["int_trip_ranges"] < 12 < widths["int_trip_comparison"]


def test_joined_trips_move_without_the_columns_made_of_them(spark, wh):
    """What is made row by row of other columns is neither written with the joined trips nor moved by the windows."""
    columns = {}

    def stage(df, name):
        columns[name] = set(df.columns)
        return df.checkpoint()

    got = intermediate.int_trip_punctuality(wh.stg_scheduled_trips, wh.stg_punctuality_trips, wh.stg_delay_incidents, wh.stg_routes, stage=stage)
    made = {"scheduled_duration_minutes", "departure_window", "schedule_density", "departure_delay_minutes", "travel_time_ratio", "delay_severity", "is_on_time", "trip_date"}
    assert made <= set(got.columns) and not made & columns["int_trip_comparison"]
    assert "trip_date" not in columns["int_trip_ranges"]
    assert not {"vehicle_id", "trip_id", "actual_departure_at"} & columns["int_vehicle_context"]
    mine, theirs = got.select(*intermediate.INT_PUNCTUALITY_COLUMNS), wh.int_trip_punctuality.select(*intermediate.INT_PUNCTUALITY_COLUMNS)
    assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0
