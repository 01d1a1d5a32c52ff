"""M2/M3 from stored aggregates: the additive parts of all metrics per route and month.

Every metric of a semantic model is a final expression over sums and counts.
An aggregate table holds these parts of one fact for each (route, month), so it
has as many rows as there are routes times months, whatever the fact's size.
:func:`answers` says whether a query can be answered from it, that is whether
each dimension that is asked for or filtered on is one of the route, or one of
the calendar that is the same on all days of a month; :func:`branch` answers it.
Sums of sums are the sums, so results are equal to those from the fact.

Days outside the calendar have no calendar attributes. Rows say whether their
days are inside (``in_calendar``), so a month that the calendar holds in part
is told apart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.plans.semantic import Dimension, Metric, SemanticModel, calendar_bounds, filter_cond
from routecast.plans.warehouse import Warehouse
from routecast.sources.calendar import month_key

#: Attributes of a date that all days of a month share.
MONTHLY = ("month", "month_name", "quarter", "year", "year_quarter", "season")
ROUTES, DATES = "routes", "dates"


def part_columns(metrics: Sequence[Metric]) -> dict:
    """Column name and aggregate of each additive part."""
    return {f"{m.name}__{k}": make for m in metrics for k, make in m.parts.items()}


def build(model: SemanticModel, fact: str, rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The aggregate of a fact's rows; they need ``route_id``, ``date_key`` and ``month_key``."""
    own = [m for m in model.metrics.values() if m.table == fact]
    days = dim_date.select(F.col("date_key").alias("__day"))
    known = rows.join(days, F.col("date_key") == F.col("__day"), "left").withColumn("in_calendar", F.col("__day").isNotNull())
    return known.groupBy("route_id", "month_key", "in_calendar").agg(*[make().alias(name) for name, make in part_columns(own).items()])


def _usable(d: Dimension) -> bool:
    return d.table == ROUTES or (d.table == DATES and d.column in MONTHLY)


def answers(model: SemanticModel, wh: Warehouse, fact: str, dims: Sequence[Dimension], filters: dict[str, object]) -> bool:
    """Whether the warehouse has an aggregate that answers a query of this fact.

    One that was made from other rows or another calendar than the warehouse's
    own (a copy with a table replaced) answers nothing."""
    asked = [*dims, *[model.dimensions[f] for f in filters]]
    reached = {r.references for r in model.relationships if r.table == fact}
    if not all(_usable(d) and d.table in reached for d in asked):
        return False
    # Asked for last: an aggregate may be made on demand.
    stored = wh.aggregates.get((model.name, fact))
    return stored is not None and stored.rows is getattr(wh, model.tables[fact][0]) and stored.days is wh.dim_date


def branch(model: SemanticModel, wh: Warehouse, fact: str, dims: Sequence[Dimension], metrics: Sequence[Metric], filters: dict[str, object]) -> DataFrame:
    """A fact's part of a semantic query, from its aggregate."""
    df = wh.aggregates[(model.name, fact)].parts
    months = wh.dim_date.select(month_key("date_key").alias("__month"), *MONTHLY).distinct()
    sources = {
        ROUTES: (getattr(wh, model.tables[ROUTES][0]), model.tables[ROUTES][1], F.col("route_id")),
        # NULL joins nothing: a day outside the calendar has no attributes.
        DATES: (months, "__month", F.when(F.col("in_calendar"), F.col("month_key"))),
    }
    if bounds := calendar_bounds({f: v for f, v in filters.items() if model.dimensions[f].table == DATES}):
        # The months' directories; the calendar itself decides below.
        first, last = bounds[0], bounds[1] - dt.timedelta(days=1)
        df = df.filter(F.col("month_key").between(first.year * 100 + first.month, last.year * 100 + last.month))
    for name, value in filters.items():
        d = model.dimensions[name]
        table, pk, fk = sources[d.table]
        keys = table.filter(filter_cond(d.column, value)).select(F.col(pk).alias("__key"))
        df = df.join(keys, fk == F.col("__key"), "left_semi")
    for t in dict.fromkeys(d.table for d in dims):
        table, pk, fk = sources[t]
        attributes = [F.col(d.column).alias(f"__dim_{d.name}") for d in dims if d.table == t]
        df = df.join(table.select(F.col(pk).alias(f"__pk_{t}"), *attributes), fk == F.col(f"__pk_{t}"), "left")
    sums = [F.sum(c).alias(c) for c in part_columns(metrics)]
    columns = [f"__dim_{d.name}" for d in dims]
    summed = df.groupBy(*columns).agg(*sums) if columns else df.agg(*sums)
    return summed.select(
        *[F.col(f"__dim_{d.name}").alias(d.name) for d in dims],
        *[m.final(lambda k, m=m: F.col(f"{m.name}__{k}")).alias(m.name) for m in metrics],
    )


def fact_tables(model: SemanticModel) -> list[str]:
    """The facts of a model that have metrics."""
    return list(dict.fromkeys(m.table for m in model.metrics.values()))


def build_all(models: Sequence[SemanticModel], facts: dict[str, DataFrame], dim_date: DataFrame) -> dict[tuple[str, str], tuple[str, DataFrame]]:
    """Aggregates of all models' facts and the facts' names, by (model, fact). ``facts``: rows by warehouse table."""
    known = [(m, f, m.tables[f][0]) for m in models for f in fact_tables(m)]
    return {(m.name, f): (t, build(m, f, facts[t], dim_date)) for m, f, t in known if t in facts}
