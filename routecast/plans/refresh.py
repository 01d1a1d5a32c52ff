"""S4, incremental: rebuild of the months that changed, and of no others.

``refresh_warehouse`` keeps a warehouse in a folder up to date. A manifest says
of each input and month what rows the tables were made from (a fingerprint,
:mod:`routecast.operators.fingerprints`). A refresh scans the inputs once for
their fingerprints, finds the months that differ, and rewrites those months'
directories by dynamic partition overwrite. Other months' files stay as they
are. The result is equal to a full build.

*Which months a change touches.*

- A fact of one input (trips, bookings) has the months of its rows.
- The punctuality fact has the month of the actual departure. Its schedules and
  incidents may lie in other months; the table ``landings`` says which of their
  months went into which months of the fact, and rows of changed months are
  joined with the trips to see where they land now.
- W1-W3 look four trips back in a vehicle, over the edge of a month. The last
  four trips of each (month, vehicle) are a table of their own (``tails``). From
  it come the trips that precede each month's first one (the halo), and a month
  whose halo has changed is assessed anew, from its stored joined trips.
- The route benchmarks (percentiles, mean, deviation) depend on all months.
  They are summed up from stored (month, route, delay) counts, and the columns
  that depend on them are joined to the fact when it is read, one row a route.
- A change in the routes touches all months.

The manifest is written last, as a new version, so a refresh that was cut off
is done again by the next one. One refresh at a time may write to a folder.

Tables that don't need each other are written by concurrent jobs. A first build
knows without fingerprints that it has to make all months: it takes those of
trips and bookings from the facts that it has written, whose joins then run once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routecast.operators import dims, feedback, intermediate, marts, quality, staging
from routecast.operators.fingerprints import FINGERPRINT, NO_MONTH, fingerprints
from routecast.plans.warehouse import MART_SORT, StoredParts, Warehouse, metric_parts
from routecast.sources import calendar, sinks
from routecast.sources.schemas import RawInputs

#: Raised when the tables' contents change for the same inputs: everything is then rebuilt.
LAYOUT = 3


@dataclass
class Refreshed:
    """The warehouse, and the months that each table's refresh has written."""

    warehouse: Warehouse
    written: dict[str, list[int]] = field(default_factory=dict)
    #: As ``written``, with the months that have lost their last rows.
    touched: dict[str, list[int]] = field(default_factory=dict)


def _in(months: Iterable[int] | None, column: Column) -> Column:
    """Rows of these months; all rows if ``months`` is None."""
    return F.lit(True) if months is None else F.coalesce(column, F.lit(NO_MONTH)).isin(sorted(months))


#: Fixed value: the directory of rows whose partition column is NULL.
NO_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def _month_of(directory: str) -> int:
    value = directory.removeprefix("month_key=")
    return NO_MONTH if value == NO_DIRECTORY else int(value)


class _Folder:
    """The tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _hadoop(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._hadoop(path)
        return fs.exists(at)

    def remove(self, path: str) -> None:
        fs, at = self._hadoop(path)
        fs.delete(at, True)

    def children(self, path: str) -> list[str]:
        fs, at = self._hadoop(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def read(self, name: str) -> DataFrame:
        """A table in the columns it was written with, also if it has no rows and so no files."""
        like = self.spark.read.parquet(f"{self.path('columns')}/{name}")
        return self.spark.read.schema(like.schema).parquet(self.path(name)).select(*like.columns)

    def write_months(self, df: DataFrame, name: str, months: list[int] | None, sort_by: tuple[str, ...] | None = None, number: str | None = None) -> list[int]:
        """Replaces the months' directories of a table; months without rows lose theirs. Returns the months that have rows."""
        if months is None:
            columns = df.withColumn(number, F.lit(0).cast("long")) if number else df
            columns.limit(0).write.mode("overwrite").parquet(f"{self.path('columns')}/{name}")
        before = {m: self.children(self.month_path(name, m)) for m in months or ()}
        sinks.write_months(df, self.path(name), sort_by=sort_by, whole=months is None, number=number)
        if months is None:
            return sorted(_month_of(d) for d in self.children(self.path(name)) if d.startswith("month_key="))
        # A written file has a new name; where none is, the month has no rows any more.
        gone = [m for m in months if self.children(self.month_path(name, m)) == before[m]]
        for m in gone:
            self.remove(self.month_path(name, m))
        return sorted(set(months).difference(gone))

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """A table of this refresh alone, written and read back."""
        path = self.path(f"work/{name}")
        sinks.write_table(df, path)
        return sinks.read_table(self.spark, path, df.schema).select(*df.columns)

    def month_path(self, name: str, month: int) -> str:
        return f"{self.path(name)}/month_key={month or NO_DIRECTORY}"

    def manifest(self) -> tuple[int, DataFrame | None]:
        done = [c for c in self.children(self.path("manifest")) if self.exists(f"{self.path('manifest')}/{c}/_SUCCESS")]
        if not done:
            return 0, None
        return int(done[-1].removeprefix("v")), self.spark.read.parquet(f"{self.path('manifest')}/{done[-1]}")

    def write_manifest(self, rows: list[tuple], version: int) -> None:
        df = self.spark.createDataFrame(rows, "input string, month_key int, " + ", ".join(f"{c} long" for c in FINGERPRINT))
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path('manifest')}/v{version:08d}")
        for old in self.children(self.path("manifest")):
            if old < f"v{version - 1:08d}":
                self.remove(f"{self.path('manifest')}/{old}")


def _differing(now: dict[tuple[str, int], tuple], old: dict[tuple[str, int], tuple], name: str) -> set[int]:
    """Months of an input whose rows are not the ones the tables were made from."""
    keys = {k for k in now | old if k[0] == name}
    return {m for n, m in keys if now.get((n, m)) != old.get((n, m))}


def _months(df: DataFrame, column: str = "month_key") -> set[int]:
    """The distinct months in a column: one value for each month of the data."""
    return {r[0] for r in df.select(F.coalesce(column, F.lit(NO_MONTH)).alias("m")).distinct().collect()}


def _together(*jobs: Callable[[], object]) -> list:
    """The results of jobs that don't need each other and run side by side, so that none leaves slots idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


#: HotSpot interprets methods of more bytecode than this, however often they run.
_COMPILED_BYTES = 8000


@contextmanager
def _small_methods(spark: SparkSession) -> Iterator[None]:
    """Wide projections, as the staging ones, run as compiled pieces and not as one interpreted method of Spark's whole-stage code."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), _COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: The columns of which the staged table's others are made, row by row: rows are equal if these are.
_OWN_COLUMNS = {
    "scheduled_trips": [
        "scheduled_trip_id", "trip_id", "route_id", "vehicle_id", "scheduled_departure_at", "scheduled_arrival_at", "service_type", "schedule_version",
    ],
    "delay_incidents": [
        "incident_id", "trip_id", "route_id", "delay_category", "delay_minutes", "impact_level", "reported_at", "resolved_at", "is_cascading",
        "affected_passengers",
    ],
}

#: An input's rows, and the column of their month.
_Input = tuple[DataFrame, str | None]


def _prints(inputs: dict[str, _Input]) -> dict[tuple[str, int], tuple]:
    """Fingerprints by input and month, from one scan of each input."""
    own = {n: df.select(*_OWN_COLUMNS.get(n, df.columns)) for n, (df, _) in inputs.items()}
    prints = [fingerprints(own[n], calendar.month_key(c) if c else None).select(F.lit(n).alias("input"), "*") for n, (_, c) in inputs.items()]
    return {(r[0], r[1]): tuple(r)[2:] for r in reduce(DataFrame.unionByName, prints).collect()}


def refresh_warehouse(
    spark: SparkSession,
    raw: RawInputs,
    store: str,
    date_start: dt.date = calendar.DEFAULT_START,
    date_end: dt.date = calendar.DEFAULT_END,
) -> Refreshed:
    """Brings the warehouse in the folder ``store`` up to date with ``raw``; an empty folder gets a full build.

    ``store`` is a shared folder that outlives the session. Dimensions are
    small and always rewritten, feedback if its events have changed. Driver memory is one row for each input and
    month."""
    with _small_methods(spark):
        return _refresh(_Folder(spark, store), raw, date_start, date_end)


def _refresh(at: _Folder, raw: RawInputs, date_start: dt.date, date_end: dt.date) -> Refreshed:
    spark = at.spark
    routes = staging.stg_routes(raw.routes)
    occupancy = intermediate.int_trip_occupancy(staging.stg_trips(raw.trips), routes)
    revenue = intermediate.int_booking_revenue(staging.stg_bookings(raw.bookings), routes)
    trips = staging.stg_trips(raw.punctuality_trips)
    scheduled, incidents = staging.stg_scheduled_trips(raw.scheduled_trips), staging.stg_delay_incidents(raw.delay_incidents)

    # What the tables are made from, and from which months of it.
    used = {
        "trips": (staging.stg_trips(raw.trips).filter("trip_status = 'completed'"), "departure_at"),
        "bookings": (staging.stg_bookings(raw.bookings), "booked_at"),
        "punctuality_trips": (trips.filter("trip_status = 'completed'"), "departure_at"),
        "scheduled_trips": (scheduled.filter("not _is_invalid_schedule"), "scheduled_departure_at"),
        "delay_incidents": (intermediate.valid_incidents(incidents), "reported_at"),
        "routes": (routes, None),
        "feedback_events": (raw.feedback_events.select("timestamp", *sorted({column for column, _ in feedback.PATHS.values()})), None),
    }
    facts = {"fct_trips": ("trips", marts.fct_trips(occupancy)), "fct_revenue": ("bookings", marts.fct_revenue(revenue))}
    tables = {
        "dim_routes": dims.dim_routes(routes),
        "dim_vehicles": dims.dim_vehicles(staging.stg_vehicles(raw.vehicles)),
        "dim_date": calendar.dim_date(spark, date_start, date_end),
        "dim_delay_categories": dims.dim_delay_categories(incidents),
    }
    version, manifest = at.manifest()
    old = {(r[0], r[1]): tuple(r)[2:] for r in manifest.collect()} if manifest is not None else {}
    first = manifest is None
    # A fact has its input's rows, one by one, if no route is there twice.
    in_facts = {source: name for name, (source, _) in facts.items()} if first and _one_each(routes, "route_id") else {}
    out = Refreshed(warehouse=None)
    with ThreadPoolExecutor(max_workers=len(tables) + len(facts) + 3) as pool:
        small = {name: pool.submit(sinks.write_table, df, at.path(name)) for name, df in tables.items()}
        scanned = pool.submit(_prints, {n: i for n, i in used.items() if n not in in_facts})
        now = {("layout", NO_MONTH): (LAYOUT, 0, 0, 0)}
        if not first:
            now |= scanned.result()
        whole = first or bool(_differing(now, old, "routes") or _differing(now, old, "layout"))
        changed = {n: (None if whole else _differing(now, old, n)) for n in used}

        def with_parts(table: str) -> None:
            """The stored parts of the metrics, of the months that were written."""
            small["dim_date"].result()
            if whole or out.touched[table]:
                fresh = at.read(table).filter(_in(None if whole else out.written[table], F.col("month_key")))
                made = metric_parts({table: fresh}, sinks.read_table(spark, at.path("dim_date")))
                months = None if whole else out.touched[table]
                _together(*[lambda k=key, p=parts: at.write_months(p, "_".join(k), months) for key, (_, parts) in made.items()])

        def fact(name: str) -> dict:
            source, rows = facts[name]
            months = changed[source]
            out.written[name] = []
            if months is None or months:
                out.written[name] = at.write_months(rows.filter(_in(months, F.col("month_key"))), name, _listed(months), MART_SORT[name])
            out.touched[name] = _listed(months or ())
            read = {source: (at.read(name).select(*used[source][0].columns), used[source][1])} if source in in_facts else {}
            return _together(lambda: with_parts(name), lambda: _prints(read) if read else {})[1]

        def assessed() -> tuple[DataFrame, dict]:
            made = _refresh_punctuality(at, used, routes, incidents, changed, old, out)
            with_parts("fct_punctuality")
            return made

        if whole or _differing(now, old, "feedback_events"):
            small["feedback"] = pool.submit(sinks.write_table, feedback.typed_events(raw.feedback_events), at.path("feedback"))
        writing = [pool.submit(fact, name) for name in facts]
        punctuality, halo = pool.submit(assessed).result()
        now = reduce(dict.__or__, [f.result() for f in writing], now | scanned.result() | halo)
        for f in small.values():
            f.result()

    dimensions = {name: sinks.read_table(spark, at.path(name)) for name in (*tables, "feedback")}
    rows = {name: at.read(name) for name in facts}
    rows["fct_punctuality"] = marts.with_route_statistics(at.read("fct_punctuality"), sinks.read_table(spark, at.path("route_benchmarks")))
    keys = {table: metric_parts({table: at.read(table)}, dimensions["dim_date"]) for table in rows}
    aggregates = {key: StoredParts(at.read("_".join(key)), rows[table], dimensions["dim_date"]) for table, made in keys.items() for key in made}
    at.write_manifest([(*k, *v) for k, v in now.items()], version + 1)
    out.warehouse = Warehouse(
        stg_routes=routes,
        stg_vehicles=staging.stg_vehicles(raw.vehicles),
        stg_trips=staging.stg_trips(raw.trips),
        stg_bookings=staging.stg_bookings(raw.bookings),
        stg_punctuality_trips=trips,
        stg_scheduled_trips=scheduled,
        stg_delay_incidents=incidents,
        quarantined_incidents=staging.quarantined_incidents(raw.delay_incidents),
        quarantined_schedules=staging.quarantined_schedules(raw.scheduled_trips),
        int_trip_occupancy=occupancy,
        int_booking_revenue=revenue,
        incident_rollup=intermediate.incident_rollup(incidents),
        int_trip_punctuality=punctuality.drop("month_key"),
        feedback_events=raw.feedback_events,
        rejected_feedback=feedback.rejected_events(raw.feedback_events),
        aggregates=aggregates,
        **dimensions,
        **rows,
    )
    return out


def _one_each(df: DataFrame, key: str) -> bool:
    """Whether a key is in no two rows; NULLs, which no join finds, don't count."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty()


def _listed(months: Iterable[int] | None) -> list[int] | None:
    return None if months is None else sorted(months)


def _refresh_punctuality(at: _Folder, used: dict, routes: DataFrame, incidents: DataFrame, changed: dict, old: dict, out: Refreshed) -> tuple[DataFrame, dict]:
    """The punctuality tables; returns int_trip_punctuality and the halos' fingerprints."""
    trips, scheduled, valid = (used[n][0] for n in ("punctuality_trips", "scheduled_trips", "delay_incidents"))
    trip_month = trips.select(F.col("trip_id").alias("_trip"), calendar.month_key("departure_at").alias("month_key"))
    parts = {
        n: df.select(F.lit(n).alias("input"), calendar.month_key(used[n][1]).alias("input_month"), "trip_id")
        for n, df in (("scheduled_trips", scheduled), ("delay_incidents", valid))
    }
    if changed["punctuality_trips"] is None:
        months = None
    else:
        months = set(changed["punctuality_trips"])
        touched = reduce(
            lambda a, b: a | b, [(F.col("input") == n) & _in(changed[n], F.col("input_month")) for n in ("scheduled_trips", "delay_incidents")]
        )
        if changed["scheduled_trips"] or changed["delay_incidents"]:
            landed = at.read("landings").filter(touched)
            landing = reduce(DataFrame.unionByName, parts.values()).filter(touched).join(trip_month, F.col("trip_id") == F.col("_trip"))
            months |= _months(landed) | _months(landing)

    if months is None or months:
        own = trips.filter(_in(months, calendar.month_key("departure_at")))
        planned, reported = scheduled, incidents
        if months is not None:
            # Of the other trips' schedules and incidents only a few pass the filter, and are shuffled to meet the trips.
            known = quality.key_filter(own, "trip_id")
            planned, reported = (quality.may_match(df, "trip_id", known) for df in (scheduled, incidents))
            reported = reported.join(own.select("trip_id"), "trip_id", "left_semi")
        joined = intermediate.joined_trips(planned, own, routes, intermediate.incident_rollup(reported))
        joined = joined.withColumn("month_key", calendar.month_key("actual_departure_at"))
        at.write_months(joined, "int_trip_comparison", _listed(months), number=intermediate.ROW)
        comparison = at.read("int_trip_comparison").filter(_in(months, F.col("month_key")))
        # Where the inputs' months have landed: the joined trips say it of the schedules.
        here = trip_month.filter(_in(months, F.col("month_key")))
        of_schedules = comparison.select(F.lit("scheduled_trips").alias("input"), calendar.month_key(used["scheduled_trips"][1]).alias("input_month"), "month_key")
        of_incidents = parts["delay_incidents"].join(here, F.col("trip_id") == F.col("_trip")).select("input", "input_month", "month_key")
        landings = of_schedules.unionByName(of_incidents).distinct()
        # The last trips of each vehicle in each month.
        last = Window.partitionBy("month_key", "vehicle_id").orderBy(*[F.col(c).desc_nulls_first() for c in intermediate.VEHICLE_ORDER])
        tail = intermediate.with_delays(comparison).select("month_key", "vehicle_id", *intermediate.VEHICLE_ORDER, *intermediate.VEHICLE_CARRY)
        tail = tail.withColumn("_rank", F.row_number().over(last)).filter(F.col("_rank") <= intermediate.LOOKBACK).drop("_rank")
        at.write_months(tail, "vehicle_tails", _listed(months))

    halo = _halos(at.read("vehicle_tails"))
    if months:
        # Read for its prints, and again for the months that they tell.
        halo = at.stage(halo, "halo")

    def halo_prints() -> dict:
        return {("halo", r[0]): tuple(r)[1:] for r in fingerprints(halo, F.col("month_key")).collect()}

    def land() -> None:
        if months is None or months:
            at.write_months(landings, "landings", _listed(months))

    if months is None:
        written, prints, _ = _together(lambda: _assess(at, None, None), halo_prints, land)
        assessed = None
    else:
        prints = halo_prints()
        assessed = months | _differing(prints, old, "halo")
        written = _together(lambda: _assess(at, halo, assessed) if assessed else [], land)[0]
    at.remove(at.path("work"))
    out.touched["fct_punctuality"] = _listed(assessed or ())
    out.written |= {n: written for n in ("int_trip_punctuality", "fct_punctuality")}
    return at.read("int_trip_punctuality"), prints


def _assess(at: _Folder, halo: DataFrame | None, months: set[int] | None) -> list[int]:
    """Months of joined trips assessed with the trips before them; returns the months that have rows.

    As in :func:`intermediate.assessed_numbered` the windows move narrow rows; the joined rows meet
    their context by month and number. Where all months are assessed, the trips before a month are
    at hand: the windows run over the vehicles, numbers are those of one write, and no halo is needed."""
    joined = at.read("int_trip_comparison").filter(_in(months, F.col("month_key")))
    by = [] if months is None else ["month_key"]
    both = intermediate.windowed(joined, *by)
    if months is not None:
        edge = halo.filter(_in(months, F.col("month_key"))).withColumn("_before", F.lit(True))
        both = both.withColumn("_before", F.lit(False)).unionByName(edge, allowMissingColumns=True)
    context = intermediate.vehicle_context(both, lambda df: at.stage(df, "ranged"), key=[*by, "vehicle_id"])
    if months is not None:
        context = context.filter("not _before")
    context = intermediate.route_day_context(at.stage(intermediate.of_vehicles(context, *by), "vehicle_context"))
    context = context.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col(intermediate.ROW).alias("_number"), *intermediate.CONTEXT)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by], F.col(intermediate.ROW) == F.col("_number"))
    assessed = intermediate.scored(intermediate.flagged(joined.join(context, same))).withColumn("month_key", calendar.month_key("trip_date"))
    written = at.write_months(assessed, "int_trip_punctuality", _listed(months))
    fresh = at.read("int_trip_punctuality").filter(_in(months, F.col("month_key")))

    def benchmarks() -> None:
        at.write_months(marts.delay_counts(fresh, "month_key"), "delay_counts", _listed(months))
        counts = at.read("delay_counts").groupBy("route_id", marts.DELAY).agg(F.sum("n_trips").alias("n_trips"))
        sinks.write_table(marts.benchmarks_of_counts(at.stage(counts, "counts"), at.stage), at.path("route_benchmarks"))

    _together(benchmarks, lambda: at.write_months(marts.trip_facts(fresh), "fct_punctuality", _listed(months), MART_SORT["fct_punctuality"]))
    return written


def _halos(tails: DataFrame) -> DataFrame:
    """For each month and vehicle with trips in it, the last trips before the month.

    A vehicle's window holds at most four rows for each month."""
    payload = ["vehicle_id", *intermediate.VEHICLE_ORDER, *intermediate.VEHICLE_CARRY]
    along = Window.partitionBy("vehicle_id").orderBy(*[F.col(c).asc_nulls_last() for c in intermediate.VEHICLE_ORDER])
    lags = F.array(*[F.lag(F.struct(*payload), i).over(along) for i in range(1, intermediate.LOOKBACK + 1)])
    before = F.lag(F.struct("month_key")).over(along)
    first = before.isNull() | ~before["month_key"].eqNullSafe(F.col("month_key"))
    found = tails.select("month_key", first.alias("_first"), lags.alias("_lags")).filter("_first")
    return found.select("month_key", F.explode("_lags").alias("r")).filter("r is not null").select("month_key", *[F.col("r")[c].alias(c) for c in payload])
