"""Column helpers and classifiers: the eight traps and every CASE edge."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecast.functions import classifiers as C
from routecast.functions.mathcols import rate, round_half_up_int, safe_div, strict_greatest, strict_least
from routecast.functions.timecols import dow0, minute_diff


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def test_minute_diff_counts_boundaries(spark):
    rows = [
        ("2024-01-01 10:00:50", "2024-01-01 10:01:10", 1),
        ("2024-01-01 10:00:10", "2024-01-01 10:00:50", 0),
        ("2024-01-01 10:05:00", "2024-01-01 10:00:59", -5),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1),
    ]
    schema = T.StructType(
        [T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType()), T.StructField("e", T.LongType())]
    )
    df = spark.createDataFrame([(ts(a), ts(b), e) for a, b, e in rows] + [(None, ts("2024-01-01 00:00:00"), None)], schema)
    got = df.select(minute_diff("a", "b").alias("m"), "e").collect()
    assert [r.m for r in got] == [r.e for r in got]


def test_minute_diff_ignores_session_time_zone(spark):
    schema = T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())])
    df = spark.createDataFrame([(ts("2024-03-10 01:59:30"), ts("2024-03-10 03:00:10"))], schema)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(minute_diff("a", "b")).first()[0] == 61
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dow0_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], ["d"])
    assert [r[0] for r in df.select(dow0("d")).collect()] == [6, 0, 1]


def test_rounding_cast_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("22.5"),), (Decimal("-22.5"),), (Decimal("22.4"),)], "x decimal(10,1)")
    assert [r[0] for r in df.select(round_half_up_int("x")).collect()] == [23, -23, 22]


def test_strict_greatest_least_propagate_null(spark):
    df = spark.createDataFrame([(1, None), (1, 5)], "a int, b int")
    got = df.select(strict_greatest("a", "b").alias("g"), strict_least("a", "b").alias("l")).collect()
    assert (got[0].g, got[0].l) == (None, None)
    assert (got[1].g, got[1].l) == (5, 1)


def test_safe_div_and_rate(spark):
    df = spark.createDataFrame([(1, 0), (4, 2)], "a int, b int")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, 2.0]
    r = df.agg(rate(F.col("a") > 1).alias("r"))
    assert dict(r.dtypes)["r"] == "double" and r.first().r == 0.5
    assert df.filter("a > 100").agg(rate(F.col("a") > 1)).first()[0] is None


def test_hour_bands(spark):
    df = spark.range(24).select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("id").cast("int"), F.lit(0), F.lit(0)).alias("t"))
    rows = df.select(
        F.hour("t").alias("h"),
        C.departure_window("t").alias("w"),
        C.schedule_density("t").alias("d"),
        C.incident_time_band("t").alias("b"),
    ).collect()
    by = {r.h: r for r in rows}
    assert [by[h].w for h in (4, 5, 8, 9, 11, 12, 14, 15, 17, 18, 20, 21)] == [
        "night", "early_morning", "early_morning", "morning", "morning", "midday",
        "midday", "afternoon", "afternoon", "evening", "evening", "night",
    ]
    assert [by[h].d for h in (6, 7, 9, 10, 15, 16, 18, 19)] == ["low", "high", "high", "medium", "medium", "high", "high", "low"]
    assert [by[h].b for h in (5, 6, 9, 10, 15, 16, 19, 20)] == [
        "off_peak", "morning_rush", "morning_rush", "midday", "midday", "evening_rush", "evening_rush", "off_peak",
    ]


def test_computed_severity_edges(spark):
    cases = [
        (41, 31, "critical"), (40, 31, "severe"), (41, 30, "severe"), (31, 0, "severe"), (21, 26, "severe"),
        (21, 25, "moderate"), (16, 0, "moderate"), (11, 21, "moderate"), (11, 20, "minor"), (6, 0, "minor"),
        (5, 100, "negligible"), (None, 50, "negligible"),
    ]
    df = spark.createDataFrame([(d, p) for d, p, _ in cases], "d int, p int")
    got = [r[0] for r in df.select(C.computed_severity("d", "p")).collect()]
    assert got == [e for *_, e in cases]


def test_delay_tiers_and_otp(spark):
    vals = [5, 6, 15, 16, 30, 31, 60, 61, None]
    df = spark.createDataFrame([(v,) for v in vals], "m int")
    got = [tuple(r) for r in df.select(C.delay_severity("m"), C.on_time("m")).collect()]
    assert got == [
        ("on_time", True), ("minor_delay", False), ("minor_delay", False), ("moderate_delay", False),
        ("moderate_delay", False), ("major_delay", False), ("major_delay", False), ("severe_delay", False),
        ("severe_delay", False),
    ]


def test_resolution_category_null_is_prolonged(spark):
    df = spark.createDataFrame([(15,), (16,), (45,), (46,), (None,)], "m int")
    assert [r[0] for r in df.select(C.resolution_category("m")).collect()] == [
        "rapid", "standard", "standard", "prolonged", "prolonged"
    ]


def test_schedule_quarter_and_year(spark):
    df = spark.createDataFrame([("2024-Q3",), ("2025 v1",), ("2024-Q1-Q2",), ("abcd-Q4",)], "v string")
    got = [tuple(r) for r in df.select(C.schedule_quarter("v"), C.schedule_year("v")).collect()]
    assert got == [(3, 2024), (None, 2025), (1, 2024), (4, None)]


def test_season_and_weekend(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 11, 30),), (dt.date(2024, 12, 1),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], ["d"]
    )
    got = [tuple(r) for r in df.select(C.season(F.month("d")), C.is_weekend("d")).collect()]
    assert got == [("Autumn", True), ("Winter", True), ("Winter", False), ("Spring", False)]


def test_risk_score_rounds_and_clamps(spark):
    # 1.5 * 15 = 22.5 -> 23; negative -> 0; large -> 100; NULL delay -> NULL
    df = spark.createDataFrame(
        [(15, True, False, 0.0, 0), (-40, True, False, 0.0, 0), (200, False, True, 20.0, 3), (None, False, False, 0.0, 0)],
        "d int, ot boolean, c boolean, r double, n long",
    )
    got = [r[0] for r in df.select(C.delay_risk_score("d", "ot", "c", "r", "n")).collect()]
    assert got == [23, 0, 100, None]


def test_risk_level_thresholds(spark):
    df = spark.createDataFrame(
        [(Decimal("2.00"), Decimal("100.00")), (Decimal("2.01"), Decimal("100.00")), (Decimal("5.00"), Decimal("100.00")),
         (Decimal("10.00"), Decimal("100.00")), (Decimal("10.01"), Decimal("100.00")), (Decimal("1.00"), Decimal("0.00")),
         (None, Decimal("100.00"))],
        "c decimal(18,2), r decimal(18,2)",
    )
    got = [r[0] for r in df.select(C.risk_level("c", "r")).collect()]
    assert got == ["LOW", "MODERATE", "MODERATE", "HIGH", "CRITICAL", "LOW", "LOW"]


def test_delay_cost_and_z_score(spark):
    df = spark.createDataFrame([(10, 3, 1.0, 2.0), (4, 3, 1.0, 0.0), (None, 3, 1.0, None)], "d int, p int, m double, s double")
    got = [tuple(r) for r in df.select(C.delay_cost_eur("d", "p"), C.z_score("d", "m", "s")).collect()]
    assert got == [(Decimal("7.50"), 4.5), (Decimal("0.00"), 0.0), (None, 0.0)]


def test_occupancy_ratio_is_exact_decimal(spark):
    df = spark.createDataFrame([(1, 8), (2, 0), (60, 55)], "p int, c int")
    got = [r[0] for r in df.select(C.ratio_rounded("p", "c", 4)).collect()]
    assert got == [Decimal("0.1250"), None, Decimal("1.0909")]


def test_layer_naming_is_verbatim():
    from routecast.sources.sinks import layer_path, schema_name

    assert schema_name("marts", "analytics") == "marts"
    assert schema_name(None, "analytics") == "analytics"
    assert schema_name("  ", "analytics") == "analytics"
    assert layer_path("/shared/", "Staging", "stg_trips") == "/shared/Staging/stg_trips"


def test_seed_csv_loader_is_typed_and_strict(spark, tmp_path):
    import pytest

    from routecast.sources.schemas import RAW_ROUTES
    from routecast.sources.seeds import load_seed

    good = tmp_path / "routes.csv"
    good.write_text(
        "route_id,route_name,origin,destination,distance_km,vehicle_type,base_fare_eur,frequency_daily\n"
        "RT900,A - B,A,B Airport,63,shuttle_bus,12.00,8\n"
    )
    r = load_seed(spark, str(good), RAW_ROUTES).first()
    assert r.distance_km == 63 and r.base_fare_eur == Decimal("12.00")
    bad = tmp_path / "bad.csv"
    bad.write_text(good.read_text() + "RT901,C - D,C,D,not_a_number,minivan,1.00,3\n")
    with pytest.raises(Exception):
        load_seed(spark, str(bad), RAW_ROUTES).collect()


def test_minute_diff_property_against_python(spark):
    """Random timestamps (incl. pre-1970, sub-second): boundary minutes equal
    floor(minutes since epoch) differences computed in Python."""
    import random

    rnd = random.Random(7)
    epoch = dt.datetime(1970, 1, 1)

    def rand_ts():
        return epoch + dt.timedelta(microseconds=rnd.randint(-10**15, 3 * 10**15))

    def minute_index(t):
        us = (t - epoch) // dt.timedelta(microseconds=1)
        return us // 60_000_000

    pairs = [(rand_ts(), rand_ts()) for _ in range(500)]
    schema = T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())])
    got = [r[0] for r in spark.createDataFrame(pairs, schema).select(minute_diff("a", "b")).collect()]
    assert got == [minute_index(b) - minute_index(a) for a, b in pairs]


def test_read_raw_casts_to_declared_schema(spark, tmp_path):
    from routecast.sources.schemas import RAW_VEHICLES
    from routecast.sources.seeds import read_raw

    src = spark.createDataFrame(
        [("V1", "minivan", 12, "REG-1", 2022, "active")],
        "vehicle_id string, vehicle_type string, capacity long, registration_plate string, year_manufactured long, status string",
    )
    src.write.parquet(str(tmp_path / "v"))
    df = read_raw(spark, "raw_vehicles", str(tmp_path / "v"))
    assert df.schema == RAW_VEHICLES


def test_write_table_partitioned_prunes_directories(spark, tmp_path):
    from routecast.sources.sinks import write_table

    df = spark.range(100).selectExpr("id", "cast(id % 4 as int) as part", "date_add(date'2024-01-01', cast(id as int)) as date_key")
    path = str(tmp_path / "t")
    write_table(df, path, sort_by=("date_key",), partition_by=("part",))
    read = spark.read.parquet(path).filter("part = 2")
    assert read.count() == 25
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_packed_items_are_unpacked_as_they_were(spark):
    from routecast.sources.testdata import packed_item, unpacked_item

    lines = [None, 0, 1, 7, -1, -6, 2147483647, -2147483648]
    rows = [(ln, pax, status) for ln in lines for pax in (None, *range(-2, 5)) for status in range(4)]
    df = spark.createDataFrame(rows, "line int, pax int, status int")
    packed = df.select("line", "pax", "status", packed_item(F.col("line"), F.col("pax"), F.col("status")).alias("p"))
    line, pax, status = unpacked_item(F.col("p"))
    wrong = packed.filter(~(line.eqNullSafe(F.col("line")) & pax.eqNullSafe(F.col("pax")) & status.eqNullSafe(F.col("status"))))
    assert wrong.count() == 0 and packed.select(line, pax, status).dtypes == [(c, "int") for c in packed.select(line, pax, status).columns]


def test_facts_are_written_without_a_shuffle_and_small_files_put_together(spark, tmp_path, monkeypatch):
    """Rows of 20 tasks: many files a directory at first, then a few, with the same rows in order; NULL has a directory too."""
    from routecast.sources import sinks

    df = spark.range(0, 4000, 1, 20).select(
        F.col("id"), (F.col("id") * 37 % 101).cast("int").alias("date_key"), F.when(F.col("id") % 5 != 0, (F.col("id") % 5).cast("int")).alias("month_key")
    )
    plans, compact = [], sinks.compact
    path = str(tmp_path / "t")

    def files():
        return {d.name: len(list(d.glob("part-*"))) for d in (tmp_path / "t").glob("month_key=*")}

    def noted(*a):
        plans.append(files())
        compact(*a)

    monkeypatch.setattr(sinks, "compact", noted)
    for write in (
        lambda: sinks.write_table(df, path, sort_by=("date_key",), partition_by=("month_key",)),
        lambda: sinks.write_months(df, path, sort_by=("date_key",), whole=True),
        lambda: sinks.write_months(df.filter("month_key = 3"), path, sort_by=("date_key",)),
    ):
        write()
        got = spark.read.parquet(path)
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
        assert len(files()) == 5 and max(files().values()) <= 2
    # No exchange brought the rows together: each task wrote a file for each month.
    assert set(plans[0].values()) == {20} and plans[2]["month_key=3"] == 20 and plans[2]["month_key=1"] <= 2
    for f in (tmp_path / "t").glob("month_key=*/part-*"):
        dates = [r.date_key for r in spark.read.parquet(str(f)).select("date_key").collect()]
        assert dates == sorted(dates)
    # A few files stay as they are.
    monkeypatch.setattr(sinks, "MOST_FILES", 20)
    sinks.write_table(df, path, partition_by=("month_key",))
    assert set(files().values()) == {20}
