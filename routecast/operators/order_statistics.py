"""Exact order statistics of groups from (group, value) counts.

``percentile`` keeps a map of all distinct values of a group in one task's
heap. Here the counts are rows: a partial aggregate before their shuffle, then
a running sum over ranges of (group, value), so a group with millions of
distinct values is spread over tasks like any others. Counts of parts of the
data (months) add up, so statistics can be kept up to date from stored counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.operators.windows import running_total


def value_counts(df: DataFrame, group: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """Rows of each (group, value); NULL values are counted too, so that no group is lost."""
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias(n))


def percentiles(
    counts: DataFrame, group: str, value: str, names: dict[str, float], stage: Callable[[DataFrame], DataFrame], n: str = "n"
) -> DataFrame:
    """One row for each group with its interpolated percentiles: ``names`` maps column names to shares.

    The percentile at share p of N values is at rank p * (N - 1) from 0; between
    two ranks it is interpolated as ``percentile`` does, so results are equal to
    the last bit. NULL values don't count; a group of NULLs only has NULLs."""
    known = counts.filter(F.col(value).isNotNull())
    placed = running_total(known, [group], [F.col(value).asc()], F.col(n), "__before", "__total", stage)
    hits = []
    for i, p in enumerate(names.values()):
        at = F.lit(float(p)) * (F.col("__total") - 1)
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("__before") <= rank) & (rank < F.col("__before") + F.col(n))
            hits.append(F.max(F.when(hit, F.col(value))).alias(f"__{end}{i}"))
    found = placed.groupBy(group).agg(F.max("__total").alias("__total"), *hits)
    out = []
    for i, (name, p) in enumerate(names.items()):
        at = F.lit(float(p)) * (F.col("__total") - 1)
        lo, hi = F.col(f"__lo{i}").cast("double"), F.col(f"__hi{i}").cast("double")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(name))
    found = found.select(F.col(group).alias("__group"), *out)
    groups = counts.select(group).distinct()
    return groups.join(found, F.col(group).eqNullSafe(F.col("__group")), "left").drop("__group")


def mean_and_spread(counts: DataFrame, group: str, value: str, mean: str, spread: str, n: str = "n") -> DataFrame:
    """Mean and sample standard deviation of each group, the squares taken about the mean."""
    x = F.col(value).cast("double")
    weight = F.when(F.col(value).isNotNull(), F.col(n))
    means = counts.groupBy(group).agg((F.sum(x * F.col(n)) / F.nullif(F.sum(weight), F.lit(0))).alias(mean))
    means = means.withColumnRenamed(group, "__group")
    off = counts.join(means, F.col(group).eqNullSafe(F.col("__group")))
    apart = x - F.col(mean)
    squares = F.sum(apart * apart * F.col(n)) / F.nullif(F.sum(weight) - 1, F.lit(0))
    return off.groupBy(group, mean).agg(F.sqrt(squares).alias(spread))
