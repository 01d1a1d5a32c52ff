"""Skew-safe replacements for ``Window.partitionBy(key)``.

A plain ``partitionBy(vehicle_id)`` window sends every row of one key to one
task; if a key (say, an unassigned NULL vehicle) holds a third of all trips,
that task holds a third of the data. The operators here keep each task
bounded while giving exactly the same answers:

``lookback_window``
    Row frames that only look a fixed number of rows back (``lag``, rolling
    ``rowsBetween(-k, 0)``). Rows are dealt by ranges of (key, order), so a
    hot key, a burst of rows and rows that share one timestamp or a NULL are
    all cut into ranges of about equal size. Each range then gets a *halo*:
    the last ``depth`` rows before it. The frames are evaluated inside the
    ranges, and the halo rows are dropped.

``running_total``
    The sum of a weight over all rows before a row, in one order over the whole
    table or within groups. Rows are dealt by ranges of (group, order); the
    ranges' totals are the offsets of their rows. With weight 1 it is a global
    rank that no task computes alone.

``rank_and_mean_by_group``
    ``rank() over (partition by g order by x desc)`` and ``avg(x) over
    (partition by g)``. Both only depend on the multiset of ``x`` values in
    the group, so they are computed from a ``(g, x) -> count`` histogram
    (partial aggregation before the shuffle) and joined back on ``(g, x)``;
    a hot ``(g, x)`` key is split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_HALO = "__halo"
_RANGE = "__range"


def _asc(cols: Sequence[str]) -> list[Column]:
    # the source dialect puts NULLs last in ascending order
    return [F.col(c).asc_nulls_last() for c in cols]


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in cols]


def _listed(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def ranged(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` dealt by ranges of (key, order), with the number of its range.

    The result has to be materialised before it is read more than once: two
    runs of a range exchange may cut the ranges at other places."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *_asc([*_listed(key), *order])).withColumn(_RANGE, F.spark_partition_id())


def lookback_window(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    depth: int,
    carry: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    stage: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Add window columns whose frames reach at most ``depth`` rows back.

    ``key`` is a column or several; ``order`` must make rows unique within a
    key (add a tie-break column); ``carry`` lists the columns the window expressions read.
    ``columns(spec)`` returns the new columns, built over ``spec``.
    ``stage`` materialises the ranged rows in shared storage (a written table
    or ``checkpoint``).

    Two exchanges carry the rows: one by range, one by (range, key). The
    halos come from at most ``depth`` rows of each range.
    """
    keys = _listed(key)
    payload = list(dict.fromkeys([*keys, *order, *carry]))
    base = stage(ranged(df, keys, order))

    # 1. the last `depth` rows of every range, cut before their exchange
    #    (WindowGroupLimit)
    last = Window.partitionBy(_RANGE).orderBy(*_desc([*keys, *order]))
    tails = base.select(*payload, _RANGE).withColumn("__rn", F.row_number().over(last)).filter(F.col("__rn") <= depth).drop("__rn")

    # 2. over these (ranges x depth rows: bounded by the shuffle partitions,
    #    so a single task may sort them), the rows that precede the first of
    #    a range are the last rows before that range
    along = Window.orderBy(F.col(_RANGE), *_asc([*keys, *order]))
    row = F.struct(*[F.col(c) for c in payload])
    lags = F.array(*[F.lag(row, i).over(along) for i in range(1, depth + 1)])
    before = F.lag(F.col(_RANGE), 1).over(along)
    halo = (
        tails.select(_RANGE, (before.isNull() | (before != F.col(_RANGE))).alias("__first"), lags.alias("__lags"))
        .filter("__first")
        .select(_RANGE, F.explode("__lags").alias("__r"))
        .filter(F.col("__r").isNotNull())
        .select(_RANGE, *[F.col("__r")[c].alias(c) for c in payload])
    )

    # 3. evaluate the frames per (range, key) over the range's rows + its halo
    unioned = base.withColumn(_HALO, F.lit(False)).unionByName(halo.withColumn(_HALO, F.lit(True)), allowMissingColumns=True)
    spec = Window.partitionBy(_RANGE, *keys).orderBy(*_asc(order))
    out = unioned.select("*", *[c.alias(n) for n, c in columns(spec).items()])
    return out.filter(~F.col(_HALO)).drop(_HALO, _RANGE)


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    weight: Column,
    before: str,
    total: str,
    stage: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Adds ``before``, the sum of ``weight`` (a long, never NULL) over the rows
    before a row in its group, and ``total``, the group's sum.

    ``order`` are sort expressions; rows that tie get the order they happen to
    have in their range, so it should end in something unique. NULL groups are
    a group. ``stage`` materialises the ranged rows in shared storage.

    The rows move once by range and once by (range, group); besides them one
    row for each range and group that meet, which are at most ranges + groups.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(c).asc_nulls_last() for c in group], *order]
    base = stage(df.withColumn("__w", weight.cast("long")).repartitionByRange(n, *by).withColumn(_RANGE, F.spark_partition_id()))
    met = base.groupBy(_RANGE, *group).agg(F.sum("__w").alias("__sum"))
    keys = [_RANGE, *group]
    if group:
        whole = Window.partitionBy(*group)
        earlier = whole.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        sums = met.select(*keys, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"), F.sum("__sum").over(whole).alias(total))
    else:
        # One row of all ranges' sums: as many numbers as there are shuffle partitions.
        row = met.agg(F.array_sort(F.collect_list(F.struct(_RANGE, "__sum"))).alias("__all"), F.sum("__sum").alias(total))
        until = lambda x: F.aggregate(F.filter("__all", lambda y: y[_RANGE] < x[_RANGE]), F.lit(0).cast("long"), lambda n, y: n + y["__sum"])
        made = F.transform("__all", lambda x: F.struct(x[_RANGE].alias(_RANGE), until(x).alias("__offset")))
        sums = row.select(total, F.explode(made).alias("__r")).select(F.col(f"__r.{_RANGE}").alias(_RANGE), F.col("__r.__offset").alias("__offset"), total)
    offsets = sums.select(*[F.col(c).alias(f"__o_{c}") for c in keys], "__offset", total)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = base.withColumn("__local", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in keys])
    out = local.join(offsets, same).withColumn(before, F.col("__local") + F.col("__offset"))
    return out.drop("__w", "__local", "__offset", *[f"__o_{c}" for c in keys], _RANGE)


def rank_and_mean_by_group(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    rank_name: str,
    mean_name: str,
) -> DataFrame:
    """``rank() over (partition by group order by value desc nulls first)``
    and ``avg(value) over (partition by group)`` without a per-group task."""
    hist = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    g = Window.partitionBy(*group)
    before = g.orderBy(F.col(value).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    nonnull = F.when(F.col(value).isNotNull(), F.col("__n"))
    hist = hist.select(
        *group,
        value,
        (F.lit(1) + F.coalesce(F.sum("__n").over(before), F.lit(0))).cast("int").alias(rank_name),
        (
            F.sum(F.col(value).cast("long") * F.col("__n")).over(g).cast("double")
            / F.sum(nonnull).over(g).cast("double")
        ).alias(mean_name),
    )
    keys = [*group, value]
    hist = hist.select(*[F.col(c).alias(f"__h_{c}") for c in keys], rank_name, mean_name)
    cond = None
    for c in keys:
        e = F.col(c).eqNullSafe(F.col(f"__h_{c}"))
        cond = e if cond is None else cond & e
    return df.join(hist, cond, "left").drop(*[f"__h_{c}" for c in keys])
