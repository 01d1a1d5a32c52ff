"""A refresh rewrites the months that changed and no others, and equals a full build."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from routecast.operators import intermediate, marts, staging
from routecast.operators.fingerprints import fingerprints
from routecast.plans.refresh import refresh_warehouse
from routecast.session import scratch_dir
from routecast.sources import testdata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    """Few events of few vehicles, so that vehicles look back over months; some without a vehicle or a departure."""
    bound = testdata.bind(spark, SF)
    small = F.col("trip_id").cast("int") < 240
    vehicle = F.when(F.col("trip_id").cast("int") % 7 == 0, F.lit(None)).otherwise((F.col("trip_id").cast("int") % 4).cast("string"))
    trips = bound.punctuality_trips.filter(small).withColumn(
        "departure_datetime", F.when(F.col("trip_id").cast("int") % 41 != 0, F.col("departure_datetime"))
    )
    tables = {
        "punctuality_trips": trips,
        "scheduled_trips": bound.scheduled_trips.filter(small).withColumn("vehicle_id", vehicle),
        "delay_incidents": bound.delay_incidents.filter(small),
        "trips": bound.trips.filter((F.col("trip_id").cast("int") < 4000) & (F.year("departure_datetime") == 1996)),
        "bookings": bound.bookings.filter((F.col("trip_id").cast("int") < 400) & (F.year("booking_datetime") == 1996)),
    }
    return replace(bound, **{n: df.checkpoint() if scratch_dir(spark) else df for n, df in tables.items()}, routes=bound.routes.checkpoint())


def _rounded(df):
    return sorted(map(str, df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]).collect()))


def _assert_equal(wh, raw):
    """The refreshed tables against the operators on the whole inputs."""
    routes, incidents = staging.stg_routes(raw.routes), staging.stg_delay_incidents(raw.delay_incidents)
    whole = intermediate.int_trip_punctuality(staging.stg_scheduled_trips(raw.scheduled_trips), staging.stg_trips(raw.punctuality_trips), incidents, routes)
    whole = whole.checkpoint()
    assert _rounded(wh.int_trip_punctuality) == _rounded(whole)
    assert _rounded(wh.fct_punctuality) == _rounded(marts.fct_punctuality(whole))
    assert _rounded(wh.fct_trips) == _rounded(marts.fct_trips(intermediate.int_trip_occupancy(staging.stg_trips(raw.trips), routes)))
    assert _rounded(wh.fct_revenue) == _rounded(marts.fct_revenue(intermediate.int_booking_revenue(staging.stg_bookings(raw.bookings), routes)))


def _files(spark, store, table):
    files = spark.read.parquet(f"{store}/{table}").select(F.input_file_name().alias("f")).distinct().collect()
    return {r.f for r in files}


def _month_of(path):
    return path.split("month_key=")[1].split("/")[0]


def test_refresh_rewrites_only_what_changed(spark, raw):
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    first = refresh_warehouse(spark, raw, store)
    _assert_equal(first.warehouse, raw)
    tables = ("fct_trips", "fct_revenue", "fct_punctuality", "int_trip_punctuality")
    before = {t: _files(spark, store, t) for t in tables}

    # Nothing changed: nothing is written.
    again = refresh_warehouse(spark, raw, store)
    assert all(m == [] for m in again.written.values())
    assert {t: _files(spark, store, t) for t in tables} == before

    # One month of trips leaves two minutes later; another month has none any more.
    late = F.col("departure_datetime") + F.expr("interval 2 minutes")
    in_may = F.coalesce(F.month("departure_datetime") == 5, F.lit(False))
    trips = raw.punctuality_trips.filter(~F.coalesce(F.month("departure_datetime") == 9, F.lit(False)))
    new = replace(raw, punctuality_trips=trips.withColumn("departure_datetime", F.when(in_may, late).otherwise(F.col("departure_datetime"))))
    moved = refresh_warehouse(spark, new, store)
    _assert_equal(moved.warehouse, new)
    after = {t: _files(spark, store, t) for t in tables}
    assert after["fct_trips"] == before["fct_trips"] and after["fct_revenue"] == before["fct_revenue"]
    fresh = {_month_of(f) for f in after["fct_punctuality"] - before["fct_punctuality"]}
    assert fresh == {str(m) for m in moved.written["fct_punctuality"]}
    assert "202405" in fresh and "202409" not in {_month_of(f) for f in after["fct_punctuality"]}
    kept = {_month_of(f) for f in before["fct_punctuality"] & after["fct_punctuality"]}
    assert {"202401", "202402", "202403", "202404"} <= kept


def test_what_has_not_changed_is_not_made_again(spark, raw, monkeypatch):
    from routecast.plans import refresh

    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    widths, scans = {}, []
    write, scan = refresh.sinks.write_table, refresh.fingerprints
    monkeypatch.setattr(refresh.sinks, "write_table", lambda df, path, *a, **k: (widths.setdefault(path.rsplit("/", 1)[1], len(df.columns)), write(df, path, *a, **k)))
    monkeypatch.setattr(refresh, "fingerprints", lambda df, month=None: (scans.append(df), scan(df, month))[1])
    few = replace(raw, feedback_events=raw.feedback_events.limit(50).checkpoint())
    first = refresh_warehouse(spark, few, store)
    # The windows move narrow rows; a booking's print is taken from the written fact, a schedule's of its own columns.
    assert widths["ranged"] < 16 < len(first.warehouse.int_trip_punctuality.columns)
    printed = {c: df for df in scans for c in df.columns if c in ("booking_id", "scheduled_trip_id")}
    assert f"{store}/fct_revenue/" in "".join(printed["booking_id"].inputFiles())
    assert "departure_window" not in printed["scheduled_trip_id"].columns
    before = _files(spark, store, "feedback")
    refresh_warehouse(spark, few, store)
    assert _files(spark, store, "feedback") == before
    # One event more is seen, and its table made again.
    more = replace(few, feedback_events=few.feedback_events.unionAll(few.feedback_events.limit(1)).checkpoint())
    got = refresh_warehouse(spark, more, store)
    assert _files(spark, store, "feedback") != before
    assert got.warehouse.feedback.count() == first.warehouse.feedback_events.count() + 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit


def test_routes_that_are_there_twice(spark, raw):
    """A fact then has more rows than its input, whose fingerprint isn't that of the fact."""
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    twice = replace(raw, routes=raw.routes.unionAll(raw.routes.limit(3)).checkpoint())
    first = refresh_warehouse(spark, twice, store)
    routes = staging.stg_routes(twice.routes)
    assert _rounded(first.warehouse.fct_trips) == _rounded(marts.fct_trips(intermediate.int_trip_occupancy(staging.stg_trips(raw.trips), routes)))
    again = refresh_warehouse(spark, twice, store)
    assert all(m == [] for m in again.written.values())


def test_refresh_follows_schedules_incidents_and_routes(spark, raw):
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    refresh_warehouse(spark, raw, store)
    # Incidents reported in one month but of another month's trips, one of which had none before.
    moved = F.when(F.month("reported_at") == 3, F.lit("10")).otherwise(F.col("trip_id"))
    new = replace(raw, delay_incidents=raw.delay_incidents.withColumn("trip_id", moved))
    got = refresh_warehouse(spark, new, store)
    _assert_equal(got.warehouse, new)
    assert 0 < len(got.written["fct_punctuality"]) < 12
    # A schedule's trip departs in another month than planned.
    newer = replace(new, scheduled_trips=new.scheduled_trips.withColumn("scheduled_departure_at", F.when(F.col("trip_id") == "30", F.expr("scheduled_departure_at - interval 70 days")).otherwise(F.col("scheduled_departure_at"))))
    got = refresh_warehouse(spark, newer, store)
    _assert_equal(got.warehouse, newer)
    assert got.written["fct_trips"] == [] and got.written["fct_punctuality"]
    # A route's name is in every month's rows.
    renamed = replace(newer, routes=newer.routes.withColumn("route_name", F.concat("route_name", F.lit("!"))))
    got = refresh_warehouse(spark, renamed, store)
    _assert_equal(got.warehouse, renamed)


def test_refresh_of_empty_inputs(spark, raw):
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    none = replace(raw, punctuality_trips=raw.punctuality_trips.limit(0), trips=raw.trips.limit(0))
    got = refresh_warehouse(spark, none, store)
    assert got.warehouse.fct_punctuality.count() == 0 and got.warehouse.fct_trips.count() == 0
    got = refresh_warehouse(spark, raw, store)
    _assert_equal(got.warehouse, raw)


def test_a_cut_off_refresh_is_done_again(spark, raw, monkeypatch):
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    less = replace(raw, trips=raw.trips.filter(F.month("departure_datetime") != 3))
    refresh_warehouse(spark, less, store)
    from routecast.plans import refresh

    monkeypatch.setattr(refresh._Folder, "write_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh_warehouse(spark, raw, store)
    monkeypatch.undo()
    got = refresh_warehouse(spark, raw, store)
    assert got.written["fct_trips"]
    _assert_equal(got.warehouse, raw)


def test_fingerprints_see_places_of_nulls_and_repeats(spark):
    def f(rows):
        return fingerprints(spark.createDataFrame(rows, "m int, a string, b string"), F.col("m")).collect()

    assert f([(1, None, "x")]) != f([(1, "x", None)])
    assert f([(1, "x", "y")]) != f([(1, "x", "y"), (1, "x", "y")])
    assert f([(1, "x", "y"), (1, "z", "y")]) == f([(1, "z", "y"), (1, "x", "y")])
    assert [r.month_key for r in f([(None, "x", "y")])] == [0]


def test_windows_and_joins_of_a_refresh_take_few_rows(spark, raw, monkeypatch):
    """All months are assessed without rows from before a month; of some months' trips few others' schedules and incidents meet them."""
    from routecast.plans import refresh

    staged, passed = {}, []
    stage, match = refresh._Folder.stage, refresh.quality.may_match

    def noted(self, df, name):
        out = stage(self, df, name)
        staged[name] = out.count()
        return out

    def told(df, key, made):
        out = match(df, key, made)
        passed.append((out.count(), df.count()))
        return out

    monkeypatch.setattr(refresh._Folder, "stage", noted)
    monkeypatch.setattr(refresh.quality, "may_match", told)
    store = f"{scratch_dir(spark)}/refresh-{uuid.uuid4().hex}"
    less = replace(raw, punctuality_trips=raw.punctuality_trips.filter(~F.coalesce(F.month("departure_datetime") == 5, F.lit(False))))
    first = refresh_warehouse(spark, less, store)
    assert staged["ranged"] == first.warehouse.int_trip_punctuality.count() and "halo" not in staged and passed == []
    got = refresh_warehouse(spark, raw, store)
    assert staged["halo"] > 0 and len(passed) == 2 and all(0 < kept < n / 2 for kept, n in passed)
    _assert_equal(got.warehouse, raw)
    # Joined trips are written without what is made of them row by row.
    assert "departure_delay_minutes" not in spark.read.parquet(f"{store}/int_trip_comparison").columns
