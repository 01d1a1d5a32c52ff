"""Day spine and the date dimension.

The spine is generated on the executors from a one-row seed, so its size is
known from the parameters alone: ``(end - start)`` days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.functions.classifiers import season

DEFAULT_START = dt.date(2024, 1, 1)
DEFAULT_END = dt.date(2026, 1, 1)


def _as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def month_key(date: Column | str) -> Column:
    """Year and month as one integer, 202401 for January 2024: the facts' partition column."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def in_period(start: dt.date | str, end: dt.date | str) -> Column:
    """Rows of a fact in ``[start, end)``: a ``date_key`` range for the row
    groups, and a ``month_key`` range for the directories."""
    s, e = _as_date(start), _as_date(end)
    last = e - dt.timedelta(days=1)
    days = (F.col("date_key") >= F.lit(s)) & (F.col("date_key") < F.lit(e))
    return days & F.col("month_key").between(s.year * 100 + s.month, last.year * 100 + last.month)


def last_full_quarter(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """[start, end) of the last full calendar quarter before ``as_of``."""
    d = _as_date(as_of)
    end = dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
    start = dt.date(end.year - 1, 10, 1) if end.month == 1 else dt.date(end.year, end.month - 3, 1)
    return start, end


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day in ``[start, end)`` as column ``date_day``."""
    s, e = _as_date(start), _as_date(end)
    if e <= s:
        return spark.range(0).select(F.lit(None).cast("date").alias("date_day"))
    days = (e - s).days
    # sequence() is end-inclusive, so stop one day early.
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(s), F.lit(s + dt.timedelta(days=days - 1)))).alias("date_day")
    )


def dim_date(spark: SparkSession, start: dt.date | str = DEFAULT_START, end: dt.date | str = DEFAULT_END) -> DataFrame:
    d = F.col("date_day")
    month = F.month(d)
    dow = (F.dayofweek(d) - 1).cast("int")
    return date_spine(spark, start, end).select(
        d.cast("date").alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        month.cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.quarter(d).cast("int").alias("quarter"),
        F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "E").alias("day_name"),
        season(month).alias("season"),
        F.when(dow.isin(0, 6), False).otherwise(True).alias("is_weekday"),
    )
