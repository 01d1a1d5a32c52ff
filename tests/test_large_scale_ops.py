"""Operators built for inputs beyond one task: fingerprints, filters, buckets, ranges, two-level rollups."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from routecast.operators import intermediate, marts, order_statistics, quality, staging
from routecast.operators.windows import running_total
from routecast.plans import colocated, reports
from routecast.session import scratch_dir


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _checkpoint(df):
    return df.checkpoint()


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    return scratch_dir(spark)


# -- running totals and order statistics --------------------------------------


def test_running_total_over_everything_and_in_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 9) or None, i, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, id int, w int")
    for group in ([], ["g"]):
        got = running_total(df, group, [F.col("x").desc_nulls_last(), F.col("id").asc()], F.col("w"), "before", "total", _checkpoint)
        assert "before" in got.columns and got.count() == 500
        last = {}
        for r in sorted(got.collect(), key=lambda r: (r.x is None, -(r.x or 0), r.id)):
            g = r.g if group else 0
            assert r.before == last.get(g, 0)
            last[g] = r.before + r.w
        for r in got.collect():
            assert r.total == last[r.g if group else 0]
    empty = running_total(df.limit(0), [], [F.col("id").asc()], F.lit(1), "before", "total", _checkpoint)
    assert empty.count() == 0


def test_percentiles_equal_the_builtin(spark):
    """Fractional values, ties, NULLs, NULL groups, a group of NULLs, one with very many distinct values."""
    rng = random.Random(9)
    rows = [("hot", rng.uniform(-50, 50)) for _ in range(3000)] + [("few", float(rng.randint(0, 3))) for _ in range(400)]
    rows += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", None), ("none", None), ("few", None), (None, 3.0), (None, 4.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    names = {f"p{int(p * 100)}": p for p in (0.0, 0.5, 0.75, 0.9, 0.95, 1.0)}
    counts = order_statistics.value_counts(df, ["g"], "v")
    got = order_statistics.percentiles(counts, "g", "v", names, _checkpoint)
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in names.items()])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spread = order_statistics.mean_and_spread(counts, "g", "v", "m", "s")
    for r in spread.join(df.groupBy("g").agg(F.avg("v").alias("am"), F.stddev_samp("v").alias("as")), "g").collect():
        assert r.m == (None if r.am is None else pytest.approx(r.am, rel=1e-12))
        assert r.s == (None if r["as"] is None else pytest.approx(r["as"], rel=1e-9))


def test_benchmarks_hold_no_value_map(spark, wh):
    counts = marts.delay_counts(wh.int_trip_punctuality)
    plan = _plan(marts.benchmarks_of_counts(counts, lambda df, name: df.checkpoint()))
    assert "percentile" not in plan.lower().replace("p50_departure", "")


def test_g2_ranks_without_one_task(spark, wh):
    report = reports.revenue_at_risk(wh, None)
    plan = _plan(report)
    assert not any("Window" in line and "SinglePartition" in line for line in plan.splitlines()) and "Window [row_number()" not in plan
    rows = report.collect()
    assert [r.exposure_rank for r in rows] == list(range(1, len(rows) + 1))
    assert dict(report.dtypes)["exposure_rank"] == "int"


# -- uniqueness and relationships ----------------------------------------------


def _d(rows, spark):
    return spark.createDataFrame(rows, "k string, n int")


def test_fingerprints_that_collide_are_told_apart(spark, monkeypatch):
    """Four fingerprints for all values: every value is suspect, only real repeats are found."""
    monkeypatch.setattr(quality, "fingerprint", lambda place, value: F.pmod(F.xxhash64(value), F.lit(4)))
    df = _d([(f"v{i}", i) for i in range(50)] + [("v7", 99), ("v7", 100), (None, 1), (None, 2), ("", 3), ("", 4)], spark)
    assert {(r.k, r.n_records) for r in quality.unique_failures(df, "k").collect()} == {("v7", 3), ("", 2)}
    got = quality.repeated_values([(df, {3: "k", 5: "n"})]).collect()
    assert {(r.place, r.value, r.n) for r in got} == {(3, "v7", 3), (3, "", 2), (5, "1", 2), (5, "2", 2), (5, "3", 2), (5, "4", 2)}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_unique_failures_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(quality, "BROADCAST_FINGERPRINTS", limit)
    df = _d([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 4)], spark)
    assert [tuple(r) for r in quality.unique_failures(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.unique_failures(df, "n").collect()] == [(4, 2)]
    none = quality.unique_failures(df.limit(0), "n")
    assert none.count() == 0 and none.dtypes == [("n", "int"), ("n_records", "bigint")]


def test_summary_counts_every_kind_of_failure(spark):
    child = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), ("b", None)], "k string, fk string")
    parent = spark.createDataFrame([("x",), ("x",), (None,)], "pk string")
    checks = [
        quality.Check("child", "k", "unique"), quality.Check("child", "k", "not_null"), quality.Check("child", "fk", "not_null"),
        quality.Check("child", "fk", "relationships", "parent", "pk"), quality.Check("parent", "pk", "unique"), quality.Check("parent", "pk", "not_null"),
        quality.Check("child", "fk", "unique"), quality.Check("bad", "why", "quarantine"),
    ]
    bad = spark.createDataFrame([("r",)], "why string")
    got = {(r.model, r.column_name, r.test): r.failures for r in quality.dq_summary({"child": child, "parent": parent, "bad": bad}, checks).collect()}
    assert got == {
        ("child", "k", "unique"): 1, ("child", "k", "not_null"): 1, ("child", "fk", "not_null"): 1, ("child", "fk", "relationships"): 1,
        ("parent", "pk", "unique"): 1, ("parent", "pk", "not_null"): 1, ("child", "fk", "unique"): 1, ("bad", "why", "quarantine"): 1,
    }


@pytest.mark.parametrize("bits,words,broadcast", [(16, 1 << 22, 1 << 20), (1, 1 << 22, 1 << 20), (1, 1 << 22, 0), (16, 0, 1 << 20)])
def test_filtered_orphans(spark, monkeypatch, bits, words, broadcast):
    """A good filter, one so full that most orphans pass it, and none at all: the same rows."""
    monkeypatch.setattr(quality, "BITS_A_KEY", bits)
    monkeypatch.setattr(quality, "MOST_WORDS", words)
    monkeypatch.setattr(quality, "BROADCAST_FINGERPRINTS", broadcast)
    parent = spark.createDataFrame([(f"p{i}",) for i in range(400)] + [("p1",), (None,)], "pk string")
    rows = [(f"p{i % 600}", i) for i in range(3000)] + [(None, -1)]
    child = spark.createDataFrame(rows, "fk string, id int")
    got = sorted(tuple(r) for r in quality.filtered_orphans(child, "fk", parent, "pk").collect())
    assert got == sorted((k, i) for k, i in rows if k and int(k[1:]) >= 400)
    assert quality.filtered_orphans(child, "fk", parent.limit(0), "pk").count() == 3000
    assert quality.filtered_orphans(child.limit(0), "fk", parent, "pk").count() == 0


def test_filter_turns_most_strangers_away(spark):
    parent = spark.range(5000).select(F.concat(F.lit("p"), "id").alias("pk"))
    row, words = quality.key_filter(parent, "pk")
    filled = row.scalar()
    probe = spark.range(20_000).select(F.concat(F.lit("p"), "id").alias("k"))
    word, bits = quality._place(F.col("k"), words)
    inside = F.element_at(filled, (word + 1).cast("int")).bitwiseAND(bits) == bits
    got = probe.filter(inside).select(F.substring("k", 2, 9).cast("int").alias("i"))
    assert got.filter("i < 5000").count() == 5000  # no key is lost
    assert got.filter("i >= 5000").count() < 300  # of 15,000 strangers


# -- rollups and buckets -----------------------------------------------------------


def test_rollup_has_no_object_aggregate(spark, wh):
    plan = _plan(intermediate.incident_rollup(wh.stg_delay_incidents))
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan


def test_rollup_of_a_trip_with_many_incidents(spark):
    """A trip that holds most incidents; lists in order, NULL categories left out of them."""
    import datetime as dt

    from routecast.sources.schemas import RAW_DELAY_INCIDENTS

    t0 = dt.datetime(2024, 1, 1, 8)
    cats = ["weather_conditions", " Road_Closure", None, "other", "zzz unknown"]
    rows = [(f"I{i:05d}", "hot" if i % 4 else f"T{i}", "RT001", cats[i % 5], str(i % 50), " Low", t0, t0 + dt.timedelta(minutes=99), "true" if i % 91 == 0 else "false", "3") for i in range(4000)]
    inc = staging.stg_delay_incidents(spark.createDataFrame(rows, RAW_DELAY_INCIDENTS))
    hot = {r.trip_id: r for r in intermediate.incident_rollup(inc).collect()}["hot"]
    kept = [(i, cats[i % 5], i % 50) for i in range(4000) if i % 4 and i % 50]
    assert hot.incident_count == len(kept) and hot.total_incident_delay_minutes == sum(k[2] for k in kept)
    assert hot.delay_categories == "other, road_closure, weather_conditions, zzz unknown"
    worst = min(kept, key=lambda k: (-k[2], k[0]))
    assert hot.primary_delay_category == worst[1].strip().lower()
    assert hot.max_single_delay_minutes == 49 and hot.has_cascading_incident == 1


def test_bucketed_trips_join_without_an_exchange(spark, wh):
    database = f"routecast_{uuid.uuid4().hex}"
    root = f"{scratch_dir(spark)}/{database}"
    colocated.write_layout(wh.stg_scheduled_trips, wh.stg_punctuality_trips, wh.stg_delay_incidents, database, root, 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(colocated.comparison(spark, database, F.broadcast(wh.dim_routes)))
        assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    again = colocated.comparison(spark, database, wh.stg_routes)
    plain = intermediate.flagged_comparison(wh.stg_scheduled_trips, wh.stg_punctuality_trips, wh.stg_routes, intermediate.incident_rollup(wh.stg_delay_incidents))
    assert again.exceptAll(plain).count() == 0 and plain.exceptAll(again).count() == 0
    assert sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()) == sorted(colocated.TABLES)

