"""Semantic metric API (M1-M9), a user-level replacement for querying a
semantic view.

A model declares logical tables (with primary keys), relationships
(fact foreign key -> dimension table), dimensions and metrics. Every metric
is *decomposable*: a set of additive parts (sums and counts) plus a final
expression over the summed parts. That lets ``semantic_query`` plan each
fact the way one would by hand at scale:

1. filter the dimension tables first (dimension filters become semi-joins
   on the fact's foreign key, so nothing is shuffled for them);
2. pre-aggregate the fact to (foreign keys + fact-local dimensions) --
   partial aggregation runs before the shuffle and the result has at most
   one row per key combination, whatever the skew of the fact;
3. join that small result to the dimension tables that provide the asked
   dimensions, re-aggregate the parts to the asked dimensions, and apply the
   final expressions.

Metrics from several facts (M3) are computed one branch per fact and
aligned with ``unionByName`` + ``groupBy(dims)``: no fan-out between facts,
and NULL dimension members align (a join would drop them).

A branch whose dimensions and filters are the route's or whole months' reads
the warehouse's stored aggregates in place of the fact, if it has them
(``plans.aggregates``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecast.plans.warehouse import Warehouse
from routecast.sources.calendar import in_period


@dataclass(frozen=True)
class Metric:
    name: str
    table: str
    parts: dict[str, Callable[[], Column]]
    final: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Dimension:
    name: str
    table: str
    column: str


@dataclass(frozen=True)
class Relationship:
    name: str
    table: str
    foreign_key: str
    references: str


@dataclass
class SemanticModel:
    name: str
    tables: dict[str, tuple[str, str]]  # logical name -> (warehouse attribute, primary key)
    relationships: list[Relationship]
    dimensions: dict[str, Dimension]
    metrics: dict[str, Metric]
    facts: dict[str, str] = field(default_factory=dict)  # row-level fact name -> "table.column"

    def relationship(self, table: str, target: str) -> Relationship | None:
        for r in self.relationships:
            if r.table == table and r.references == target:
                return r
        return None


# --- metric constructors ---------------------------------------------------
def _sum(table: str, name: str, expr: Callable[[], Column], cast: str | None = None) -> Metric:
    def final(p):
        v = p("s")
        return v.cast(cast) if cast else v

    return Metric(name, table, {"s": lambda: F.sum(expr())}, final)


def _count(table: str, name: str, expr: Callable[[], Column]) -> Metric:
    return Metric(name, table, {"n": lambda: F.count(expr())}, lambda p: p("n").cast("long"))


def _avg(table: str, name: str, expr: Callable[[], Column]) -> Metric:
    return Metric(
        name,
        table,
        {"s": lambda: F.sum(expr()), "n": lambda: F.count(expr())},
        lambda p: p("s").cast("double") / F.when(p("n") != 0, p("n")).cast("double"),
    )


def _rate(table: str, name: str, cond: Callable[[], Column]) -> Metric:
    """avg(case when cond then 1.0 else 0.0 end), as a double."""
    return Metric(
        name,
        table,
        {"k": lambda: F.count_if(cond()), "n": lambda: F.count(F.lit(1))},
        lambda p: p("k").cast("double") / F.when(p("n") != 0, p("n")).cast("double"),
    )


def _col(c: str) -> Callable[[], Column]:
    return lambda: F.col(c)


# The names of tables, relationships, dimensions, metrics and facts in both
# models are fixed values: they are the interface that queries are written to.
# --- M1 / M7 / M9: operations model ----------------------------------------
OPERATIONS = SemanticModel(
    name="operations",
    tables={
        "trips": ("fct_trips", "trip_id"),
        "revenue": ("fct_revenue", "booking_id"),
        "routes": ("dim_routes", "route_id"),
        "dates": ("dim_date", "date_key"),
        "vehicles": ("dim_vehicles", "vehicle_id"),
    },
    relationships=[
        Relationship("trips_to_routes", "trips", "route_id", "routes"),
        Relationship("trips_to_dates", "trips", "date_key", "dates"),
        Relationship("trips_to_vehicles", "trips", "vehicle_id", "vehicles"),
        Relationship("revenue_to_routes", "revenue", "route_id", "routes"),
        Relationship("revenue_to_dates", "revenue", "date_key", "dates"),
    ],
    dimensions={
        d.name: d
        for d in [
            Dimension("route_name", "routes", "route_name"),
            Dimension("origin", "routes", "origin"),
            Dimension("destination", "routes", "destination"),
            Dimension("route_vehicle_type", "routes", "vehicle_type"),
            Dimension("distance_km", "routes", "distance_km"),
            Dimension("full_date", "dates", "full_date"),
            Dimension("month", "dates", "month"),
            Dimension("month_name", "dates", "month_name"),
            Dimension("quarter", "dates", "quarter"),
            Dimension("year", "dates", "year"),
            Dimension("year_quarter", "dates", "year_quarter"),
            Dimension("season", "dates", "season"),
            Dimension("is_weekday", "dates", "is_weekday"),
            Dimension("day_name", "dates", "day_name"),
            Dimension("veh_type", "vehicles", "vehicle_type"),
            Dimension("max_capacity", "vehicles", "capacity"),
            Dimension("booking_status", "revenue", "booking_status"),
            Dimension("payment_method", "revenue", "payment_method"),
            Dimension("channel", "revenue", "channel"),
            Dimension("trip_status", "trips", "trip_status"),
        ]
    },
    metrics={
        m.name: m
        for m in [
            _sum("revenue", "total_revenue", _col("total_fare"), "decimal(38,2)"),
            _sum(
                "revenue",
                "completed_revenue",
                lambda: F.when(F.col("booking_status") == "completed", F.col("total_fare")).otherwise(F.lit(0)),
                "decimal(38,2)",
            ),
            _sum("trips", "total_passengers", _col("passengers_onboard"), "long"),
            _avg("trips", "average_occupancy_rate", _col("occupancy_rate")),
            _count("trips", "trip_count", _col("trip_id")),
            _count("revenue", "booking_count", _col("booking_id")),
            Metric(
                "revenue_per_passenger",
                "revenue",
                {"f": lambda: F.sum("total_fare"), "p": lambda: F.sum("passengers")},
                lambda p: p("f").cast("double") / F.when(p("p") != 0, p("p")).cast("double"),
            ),
        ]
    },
    facts={
        "passengers_onboard": "trips.passengers_onboard",
        "vehicle_capacity": "trips.vehicle_capacity",
        "occupancy_rate": "trips.occupancy_rate",
        "passengers": "revenue.passengers",
        "fare_per_passenger": "revenue.fare_per_passenger",
        "total_fare": "revenue.total_fare",
    },
)

# --- M1 / M8: punctuality model ---------------------------------------------
_P = "punctuality"
PUNCTUALITY = SemanticModel(
    name="punctuality",
    tables={
        "punctuality": ("fct_punctuality", "trip_id"),
        "delay_categories": ("dim_delay_categories", "delay_category_key"),
        "routes": ("dim_routes", "route_id"),
        "dates": ("dim_date", "date_key"),
        "vehicles": ("dim_vehicles", "vehicle_id"),
    },
    relationships=[
        Relationship("punctuality_to_routes", _P, "route_id", "routes"),
        Relationship("punctuality_to_dates", _P, "date_key", "dates"),
        Relationship("punctuality_to_vehicles", _P, "vehicle_id", "vehicles"),
        Relationship("punctuality_to_delay_categories", _P, "delay_category_key", "delay_categories"),
    ],
    dimensions={
        d.name: d
        for d in [
            Dimension("route_name", "routes", "route_name"),
            Dimension("origin", "routes", "origin"),
            Dimension("destination", "routes", "destination"),
            Dimension("distance_km", "routes", "distance_km"),
            Dimension("full_date", "dates", "full_date"),
            # an addition to the source's 30 dimensions: it orders month_name
            Dimension("month", "dates", "month"),
            Dimension("month_name", "dates", "month_name"),
            Dimension("quarter", "dates", "quarter"),
            Dimension("year", "dates", "year"),
            Dimension("year_quarter", "dates", "year_quarter"),
            Dimension("season", "dates", "season"),
            Dimension("is_weekday", "dates", "is_weekday"),
            Dimension("day_name", "dates", "day_name"),
            Dimension("vehicle_type", "vehicles", "vehicle_type"),
            Dimension("capacity", "vehicles", "capacity"),
            Dimension("service_type", _P, "service_type"),
            Dimension("departure_window", _P, "departure_window"),
            Dimension("is_weekend_service", _P, "is_weekend_service"),
            Dimension("schedule_density", _P, "schedule_density"),
            Dimension("delay_severity", _P, "delay_severity"),
            Dimension("is_on_time", _P, "is_on_time"),
            Dimension("is_on_time_departure", _P, "is_on_time_departure"),
            Dimension("has_cascading_incident", _P, "has_cascading_incident"),
            Dimension("is_sla_breach", _P, "is_sla_breach"),
            Dimension("primary_delay_category", _P, "primary_delay_category"),
            Dimension("route_delay_percentile_band", _P, "route_delay_percentile_band"),
            Dimension("delay_category", "delay_categories", "delay_category"),
            Dimension("delay_domain", "delay_categories", "delay_domain"),
            Dimension("controllability", "delay_categories", "controllability"),
            Dimension("mitigation_strategy", "delay_categories", "mitigation_strategy"),
            Dimension("expected_frequency_tier", "delay_categories", "expected_frequency_tier"),
        ]
    },
    metrics={
        m.name: m
        for m in [
            _rate(_P, "on_time_rate", lambda: F.col("is_on_time") == F.lit(True)),
            _avg(_P, "avg_departure_delay", _col("departure_delay_minutes")),
            _avg(_P, "avg_arrival_delay", _col("arrival_delay_minutes")),
            _sum(_P, "total_delay_cost", _col("estimated_delay_cost_eur"), "decimal(38,2)"),
            _sum(_P, "total_passenger_delay_impact", _col("total_passenger_delay_minutes"), "long"),
            _rate(_P, "sla_breach_rate", lambda: F.col("is_sla_breach") == F.lit(True)),
            _rate(_P, "severe_delay_rate", lambda: F.col("delay_severity").isin("major_delay", "severe_delay")),
            _rate(_P, "cascade_rate", lambda: F.col("has_cascading_incident") == F.lit(True)),
            _avg(_P, "avg_delay_risk_score", _col("delay_risk_score")),
            _count(_P, "delayed_trip_count", lambda: F.when(F.col("is_on_time") == F.lit(False), F.col("trip_id"))),
        ]
    },
    facts={
        "departure_delay_minutes": "punctuality.departure_delay_minutes",
        "arrival_delay_minutes": "punctuality.arrival_delay_minutes",
        "scheduled_duration_minutes": "punctuality.scheduled_duration_minutes",
        "actual_duration_minutes": "punctuality.actual_duration_minutes",
        "travel_time_ratio": "punctuality.travel_time_ratio",
        "incident_count": "punctuality.incident_count",
        "total_incident_delay_minutes": "punctuality.total_incident_delay_minutes",
        "total_passenger_delay_minutes": "punctuality.total_passenger_delay_minutes",
        "delay_risk_score": "punctuality.delay_risk_score",
        "vehicle_rolling_avg_delay_5trips": "punctuality.vehicle_rolling_avg_delay_5trips",
        "passengers_onboard": "punctuality.passengers_onboard",
        "estimated_delay_cost_eur": "punctuality.estimated_delay_cost_eur",
        "sla_threshold_minutes": "delay_categories.sla_threshold_minutes",
        "cascade_risk_factor": "delay_categories.cascade_risk_factor",
    },
)


class SemanticError(ValueError):
    pass


def _table(model: SemanticModel, wh: Warehouse, logical: str) -> DataFrame:
    return getattr(wh, model.tables[logical][0])


@dataclass(frozen=True)
class Between:
    """A filter value: low <= member <= high; an end that is None is open."""

    low: object = None
    high: object = None


def filter_cond(column: str, value) -> Column:
    """A member, a list of members (None among them is the missing member), a
    :class:`Between`, or None for the missing member."""
    if value is None:
        return F.col(column).isNull()
    if isinstance(value, Between):
        ends = [F.col(column) >= F.lit(value.low)] if value.low is not None else []
        ends += [F.col(column) <= F.lit(value.high)] if value.high is not None else []
        return reduce(lambda a, b: a & b, ends, F.col(column).isNotNull())
    if isinstance(value, (list, tuple, set, frozenset)):
        present = [v for v in value if v is not None]
        cond = F.col(column).isin(present)
        return cond | F.col(column).isNull() if len(present) < len(value) else cond
    return F.col(column) == F.lit(value)


def _first_and_last(value) -> tuple | None:
    """The least and greatest member a filter value lets through, if both are known."""
    if value is None:
        return None
    if isinstance(value, Between):
        return None if value.low is None or value.high is None else (value.low, value.high)
    if isinstance(value, (list, tuple, set, frozenset)):
        return None if not value or None in value else (min(value), max(value))
    return value, value


def calendar_bounds(filters: dict[str, object]) -> tuple[dt.date, dt.date] | None:
    """[start, end) that calendar filters imply for ``date_key``, if any.

    ``year``, ``year_quarter`` and ``full_date`` bound the fact's dates, so
    its scan opens only those months; other calendar filters recur every year
    and bound nothing."""
    bounds = []
    if "year" in filters and (ends := _first_and_last(filters["year"])):
        bounds.append((dt.date(int(ends[0]), 1, 1), dt.date(int(ends[1]) + 1, 1, 1)))
    if "year_quarter" in filters and (ends := _first_and_last(filters["year_quarter"])):
        (y0, q0), (y1, q1) = (map(int, str(e).split("-Q")) for e in ends)
        bounds.append((dt.date(y0, 3 * q0 - 2, 1), dt.date(y1 + (q1 == 4), 3 * q1 % 12 + 1, 1)))
    if "full_date" in filters and (ends := _first_and_last(filters["full_date"])):
        bounds.append((ends[0], ends[1] + dt.timedelta(days=1)))
    return (max(b[0] for b in bounds), min(b[1] for b in bounds)) if bounds else None


def dimension_members(
    model: SemanticModel, wh: Warehouse, dimensions: Sequence[str], filters: dict[str, object] | None = None
) -> DataFrame:
    """M4: the distinct members of dimensions.

    Of one logical table: straight from it. Of several: the combinations that
    occur in the facts that reach them all (every such fact adds its own)."""
    filters = dict(filters or {})
    dims = [model.dimensions[d] for d in dimensions]
    tables = {d.table for d in [*dims, *[model.dimensions[f] for f in filters]]}
    if len(tables) == 1:
        src = _table(model, wh, tables.pop())
        for name, value in filters.items():
            src = src.filter(filter_cond(model.dimensions[name].column, value))
        return src.select(*[F.col(d.column).alias(d.name) for d in dims]).distinct()
    facts = dict.fromkeys(r.table for r in model.relationships)
    reaching = [f for f in facts if all(t == f or model.relationship(f, t) for t in tables)]
    if not reaching:
        raise SemanticError(f"no fact table reaches all of {sorted(tables)}")
    branches = [_fact_branch(model, wh, f, dims, [], filters) for f in reaching]
    return reduce(DataFrame.unionByName, branches).distinct()


def _fact_branch(
    model: SemanticModel,
    wh: Warehouse,
    fact: str,
    dims: list[Dimension],
    metrics: list[Metric],
    filters: dict[str, object],
) -> DataFrame:
    # M6: every asked dimension must be local or one relationship away
    for d in [*dims, *[model.dimensions[f] for f in filters]]:
        if d.table != fact and model.relationship(fact, d.table) is None:
            raise SemanticError(f"dimension {d.name!r} ({d.table}) is not reachable from fact table {fact!r}")
    df = _table(model, wh, fact)

    # 1. dimension filters: the calendar as a range on the fact itself, local
    #    ones directly, remote ones as semi-joins
    by_date = {f: v for f, v in filters.items() if model.dimensions[f].table == "dates"}
    if bounds := calendar_bounds(by_date):
        df = df.filter(in_period(*bounds))
    remote_filters: dict[str, list[tuple[Dimension, object]]] = {}
    for fname, value in filters.items():
        d = model.dimensions[fname]
        if d.table == fact:
            df = df.filter(filter_cond(d.column, value))
        else:
            remote_filters.setdefault(d.table, []).append((d, value))
    for table, conds in remote_filters.items():
        rel = model.relationship(fact, table)
        pk = model.tables[table][1]
        keys = _table(model, wh, table)
        for d, value in conds:
            keys = keys.filter(filter_cond(d.column, value))
        # a semi-join needs no distinct right side (duplicates never repeat a fact row)
        keys = keys.select(F.col(pk).alias(rel.foreign_key))
        df = df.join(keys, rel.foreign_key, "left_semi")

    # 2. pre-aggregate to foreign keys + local dimensions
    local = [d for d in dims if d.table == fact]
    remote_tables = list(dict.fromkeys(d.table for d in dims if d.table != fact))
    fks = [model.relationship(fact, t).foreign_key for t in remote_tables]
    group1 = list(dict.fromkeys([*fks, *[d.column for d in local]]))
    parts = {f"{m.name}__{k}": fn for m in metrics for k, fn in m.parts.items()}
    if not parts:
        pre = df.select(*group1).distinct()
    elif group1:
        pre = df.groupBy(*group1).agg(*[fn().alias(n) for n, fn in parts.items()])
    else:
        pre = df.agg(*[fn().alias(n) for n, fn in parts.items()])
    pre = pre.select(*[F.col(c) for c in group1], *[F.col(n) for n in parts], *[
        F.col(d.column).alias(f"__dim_{d.name}") for d in local
    ]) if local else pre

    # 3. attach remote dimension attributes, re-aggregate, finish metrics
    for t in remote_tables:
        rel = model.relationship(fact, t)
        pk = model.tables[t][1]
        attrs = [d for d in dims if d.table == t]
        dim_df = _table(model, wh, t).select(
            F.col(pk).alias(f"__pk_{t}"), *[F.col(d.column).alias(f"__dim_{d.name}") for d in attrs]
        )
        pre = pre.join(dim_df, pre[rel.foreign_key] == dim_df[f"__pk_{t}"], "left")
    dim_cols = [f"__dim_{d.name}" for d in dims]
    if not parts:
        summed = pre.select(*dim_cols).distinct()
    elif dim_cols:
        summed = pre.groupBy(*dim_cols).agg(*[F.sum(n).alias(n) for n in parts])
    else:
        summed = pre.agg(*[F.sum(n).alias(n) for n in parts])
    out = [F.col(f"__dim_{d.name}").alias(d.name) for d in dims]
    for m in metrics:
        out.append(m.final(lambda k, m=m: F.col(f"{m.name}__{k}")).alias(m.name))
    return summed.select(*out)


def semantic_facts(
    model: SemanticModel,
    wh: Warehouse,
    facts: Sequence[str],
    dimensions: Sequence[str] = (),
    filters: dict[str, object] | None = None,
) -> DataFrame:
    """M1 row-level facts (drill-through): one row per row of the fact table
    with the asked facts and dimension attributes.

    The fact table is the one (among tables that have relationships) that
    holds the asked facts; facts and dimensions of referenced tables are
    attached with left joins (AQE splits a hot or missing foreign key), and
    filters on them become semi-joins on the foreign key first."""
    filters = dict(filters or {})
    unknown = [f for f in facts if f not in model.facts]
    unknown += [d for d in [*dimensions, *filters] if d not in model.dimensions]
    if unknown:
        raise SemanticError(f"unknown fact or dimension: {unknown}")
    located = {f: tuple(model.facts[f].split(".", 1)) for f in facts}
    fact_tables = {r.table for r in model.relationships}
    owners = {t for t, _ in located.values() if t in fact_tables}
    if len(owners) != 1:
        raise SemanticError("row-level facts must include facts of exactly one fact table")
    fact = owners.pop()

    # name -> (table, column) for every output column, in request order
    wanted: dict[str, tuple[str, str]] = dict(located)
    wanted.update({d: (model.dimensions[d].table, model.dimensions[d].column) for d in dimensions})
    remote = {t for t, _ in wanted.values() if t != fact}
    remote |= {model.dimensions[f].table for f in filters if model.dimensions[f].table != fact}
    for table in remote:
        if model.relationship(fact, table) is None:
            raise SemanticError(f"table {table!r} is not reachable from fact table {fact!r}")

    df = _table(model, wh, fact)
    if bounds := calendar_bounds({f: v for f, v in filters.items() if model.dimensions[f].table == "dates"}):
        df = df.filter(in_period(*bounds))
    for fname, value in filters.items():
        d = model.dimensions[fname]
        if d.table == fact:
            df = df.filter(filter_cond(d.column, value))
        else:
            rel = model.relationship(fact, d.table)
            keys = _table(model, wh, d.table).filter(filter_cond(d.column, value))
            keys = keys.select(F.col(model.tables[d.table][1]).alias(rel.foreign_key))
            df = df.join(keys, rel.foreign_key, "left_semi")

    for table in sorted({t for t, _ in wanted.values() if t != fact}):
        rel = model.relationship(fact, table)
        src = _table(model, wh, table)
        cols = {n: c for n, (t, c) in wanted.items() if t == table}
        dim_df = src.select(
            F.col(model.tables[table][1]).alias(f"__pk_{table}"),
            *[F.col(c).alias(f"__{table}__{n}") for n, c in cols.items()],
        )
        df = df.join(dim_df, F.col(rel.foreign_key) == F.col(f"__pk_{table}"), "left")
    return df.select(
        *[
            (F.col(c) if t == fact else F.col(f"__{t}__{n}")).alias(n)
            for n, (t, c) in wanted.items()
        ]
    )


def semantic_query(
    model: SemanticModel,
    wh: Warehouse,
    dimensions: Sequence[str] = (),
    metrics: Sequence[str] = (),
    filters: dict[str, object] | None = None,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """M2-M5: metrics grouped by dimensions, filtered, ordered."""
    from routecast.plans import aggregates

    filters = dict(filters or {})
    unknown = [d for d in [*dimensions, *filters] if d not in model.dimensions]
    unknown += [m for m in metrics if m not in model.metrics]
    if unknown:
        raise SemanticError(f"unknown dimension or metric: {unknown}")
    dims = [model.dimensions[d] for d in dimensions]
    if not metrics:
        res = dimension_members(model, wh, dimensions, filters)
        return res.orderBy(*order_by) if order_by else res

    by_fact: dict[str, list[Metric]] = {}
    for m in metrics:
        mm = model.metrics[m]
        by_fact.setdefault(mm.table, []).append(mm)
    branches = [
        (aggregates.branch if aggregates.answers(model, wh, fact, dims, filters) else _fact_branch)(model, wh, fact, dims, ms, filters)
        for fact, ms in by_fact.items()
    ]
    if len(branches) == 1:
        res = branches[0]
    else:
        unioned = branches[0]
        for b in branches[1:]:
            unioned = unioned.unionByName(b, allowMissingColumns=True)
        aggs = [F.max(m).alias(m) for m in metrics]
        res = unioned.groupBy(*dimensions).agg(*aggs) if dimensions else unioned.agg(*aggs)
    res = res.select(*dimensions, *metrics)
    return res.orderBy(*order_by) if order_by else res
