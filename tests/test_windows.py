"""The skew-safe window operators give exactly the plain-window answers,
including a hot key holding most rows, tied and NULL order values."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from routecast.operators.windows import lookback_window, rank_and_mean_by_group


def _rows(seed: int, n: int = 400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        key = "HOT" if rnd.random() < 0.6 else (None if rnd.random() < 0.1 else f"k{rnd.randint(0, 5)}")
        t = None if rnd.random() < 0.03 else base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6))
        val = None if rnd.random() < 0.05 else rnd.randint(-5, 60)
        out.append((f"id{i:04d}", key, t, val))
    return out


def _columns(spec):
    return {
        "roll": F.avg("v").over(spec.rowsBetween(-4, 0)),
        "prev": F.lag("v", 1).over(spec),
        "prev_t": F.lag("t", 1).over(spec),
    }


def _same_as_plain(df):
    order = [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]
    plain = df.select("id", *[c.alias(n) for n, c in _columns(Window.partitionBy("k").orderBy(*order)).items()])
    safe = lookback_window(df, "k", ["t", "id"], 4, ["v"], _columns, lambda d: d.checkpoint())
    key = lambda r: r.id
    assert sorted(plain.collect(), key=key) == sorted(safe.select("id", "roll", "prev", "prev_t").collect(), key=key)


SCHEMA = "id string, k string, t timestamp_ntz, v int"
NOON = dt.datetime(2024, 1, 1, 12)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lookback_window_matches_plain_window(spark, seed):
    _same_as_plain(spark.createDataFrame(_rows(seed), SCHEMA))


@pytest.mark.parametrize(
    "rows",
    [
        [(f"id{i:04d}", None, NOON + dt.timedelta(minutes=i), i % 7) for i in range(300)],  # one hot NULL vehicle
        [(f"id{i:04d}", "HOT", NOON, i % 7) for i in range(300)],  # one shared timestamp
        [(f"id{i:04d}", "HOT" if i % 3 else None, None, i % 7) for i in range(300)],  # NULL times
        [("a", "k", NOON, 1), ("b", "k", NOON, 2), ("c", "j", None, None)],  # fewer rows than ranges
        [],
    ],
)
def test_lookback_window_takes_hot_null_and_shared_keys(spark, rows):
    _same_as_plain(spark.createDataFrame(rows, SCHEMA))


def test_hot_key_is_cut_into_ranges(spark):
    from routecast.operators.windows import ranged

    df = spark.createDataFrame([(f"id{i:04d}", "HOT", NOON, 1) for i in range(2000)], SCHEMA)
    sizes = [r["count"] for r in ranged(df, "k", ["t", "id"]).groupBy("__range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1500


@pytest.mark.parametrize("seed", [4, 5])
def test_rank_and_mean_match_plain_window(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"id{i}", "R1" if rnd.random() < 0.7 else f"R{rnd.randint(2, 4)}", rnd.randint(1, 3),
             None if rnd.random() < 0.05 else rnd.randint(0, 10)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, g string, d int, v int")
    w = Window.partitionBy("g", "d")
    plain = df.select(
        "id",
        F.rank().over(w.orderBy(F.col("v").desc_nulls_first())).alias("rk"),
        F.avg("v").over(w).alias("m"),
    )
    safe = rank_and_mean_by_group(df, ["g", "d"], "v", "rk", "m").select("id", "rk", "m")
    assert sorted(plain.collect()) == sorted(safe.collect())


def test_lookback_window_has_two_row_exchanges(spark):
    """The rows move once by range and once by (range, key), never by the key alone."""
    df = spark.createDataFrame(_rows(9), SCHEMA)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    plans = []
    out = lookback_window(df, "k", ["t", "id"], 4, ["v"], _columns, lambda d: plans.append(plan(d)) or d.checkpoint())
    plans.append(plan(out))
    assert plans[0].count("rangepartitioning(") == 1
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plans[1])
    assert keys and all("__range" in k for k in keys)
    assert "rangepartitioning(" not in plans[1]
