"""The whole layered build (E1) as one function of the raw inputs.

``build_warehouse`` wires staging -> intermediate -> marts lazily. With a
``store`` path it materialises like the reference does: the punctuality
intermediate (read by the benchmarks and by the fact) and every mart are
written as parquet under the shared scratch folder, which also cuts the
lineage so a lost executor only recomputes from the last written layer.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.operators import dims, feedback, intermediate, marts, staging
from routecast.operators.reconciliation import QUARANTINED, Reconciliation
from routecast.session import scratch_dir
from routecast.sources import calendar, sinks, testdata
from routecast.sources.schemas import RawInputs


@dataclass(frozen=True)
class StoredParts:
    """Additive parts of metrics, and the very relations they were made from."""

    parts: DataFrame
    rows: DataFrame
    days: DataFrame


@dataclass
class Warehouse:
    stg_routes: DataFrame
    stg_vehicles: DataFrame
    stg_trips: DataFrame
    stg_bookings: DataFrame
    stg_punctuality_trips: DataFrame
    stg_scheduled_trips: DataFrame
    stg_delay_incidents: DataFrame
    quarantined_incidents: DataFrame
    quarantined_schedules: DataFrame
    int_trip_occupancy: DataFrame
    int_booking_revenue: DataFrame
    incident_rollup: DataFrame
    int_trip_punctuality: DataFrame
    dim_routes: DataFrame
    dim_vehicles: DataFrame
    dim_date: DataFrame
    dim_delay_categories: DataFrame
    fct_trips: DataFrame
    fct_revenue: DataFrame
    fct_punctuality: DataFrame
    feedback_events: DataFrame
    feedback: DataFrame
    rejected_feedback: DataFrame
    #: Stored parts of the semantic models' metrics, by (model, fact).
    aggregates: dict[tuple[str, str], StoredParts] = field(default_factory=dict)
    #: (input, outcome, rows) of the build's inputs; empty if nothing was written.
    reconciliation: list[tuple[str, str, int]] = field(default_factory=list)
    #: Folder of the layers that the build has written, if any.
    store: str | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("aggregates", "reconciliation", "store")}


class OnDemandWarehouse(Warehouse):
    """A warehouse whose tables are made when they are first read, each of them once.

    ``made`` are the fields at hand, ``makers`` make the others from the warehouse."""

    def __init__(self, made: dict[str, object] | None = None, makers: dict[str, Callable[[Warehouse], object]] | None = None, **whole):
        self._makers = makers or {}
        self._locks = {name: RLock() for name in self._makers}
        if whole:  # a copy (dataclasses.replace) has all fields
            super().__init__(**whole)
        self.__dict__.update(made or {})

    def __getattr__(self, name: str) -> object:
        # Only called for a field that is not there yet.
        if name.startswith("_") or name not in self._makers:
            raise AttributeError(name)
        with self._locks[name]:
            if name not in self.__dict__:
                self.__dict__[name] = self._makers[name](self)
            return self.__dict__[name]

    def __repr__(self) -> str:
        return f"OnDemandWarehouse(store={self.store!r})"

    def make_all(self) -> None:
        """Makes what isn't there yet. Independent tables are written by
        concurrent jobs, so that the scheduler can fill idle executor slots."""
        with ThreadPoolExecutor(max_workers=len(self._makers) + len(self.aggregates) or 1) as pool:
            futures = [pool.submit(getattr, self, name) for name in self._makers] + [pool.submit(self.aggregates.get, k) for k in self.aggregates]
            for f in futures:
                f.result()

    def tables(self) -> dict[str, DataFrame]:
        self.make_all()
        return super().tables()


class _PartsOnDemand(Mapping):
    """Stored parts by (model, fact), each written when it is first asked for."""

    def __init__(self, makers: dict[tuple[str, str], Callable[[], StoredParts]]):
        self._makers, self._made = makers, {}
        self._locks = {key: RLock() for key in makers}

    def __getitem__(self, key: tuple[str, str]) -> StoredParts:
        with self._locks[key]:
            if key not in self._made:
                self._made[key] = self._makers[key]()
            return self._made[key]

    def __contains__(self, key: object) -> bool:
        return key in self._makers

    def __iter__(self) -> Iterator[tuple[str, str]]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


MART_SORT = {
    "fct_trips": ("date_key",),
    "fct_revenue": ("date_key",),
    "fct_punctuality": ("date_key",),
}
FACT_PARTITION = ("month_key",)


def build_warehouse(
    spark: SparkSession,
    raw: RawInputs,
    date_start: dt.date = calendar.DEFAULT_START,
    date_end: dt.date = calendar.DEFAULT_END,
    store: str | None = None,
    on_demand: bool = False,
) -> Warehouse:
    """All layers over ``raw``; with ``store`` the marts, staged incidents and
    punctuality intermediates are tables under that folder. The folder belongs
    to the caller, who may remove it when the warehouse is not used any more.

    With ``on_demand`` a table is written when it is first read; the inputs
    have to stay as they are until then."""
    s_routes = staging.stg_routes(raw.routes)
    s_vehicles = staging.stg_vehicles(raw.vehicles)
    s_trips = staging.stg_trips(raw.trips)
    s_bookings = staging.stg_bookings(raw.bookings)
    s_ptrips = staging.stg_trips(raw.punctuality_trips)
    s_sched = staging.stg_scheduled_trips(raw.scheduled_trips)
    s_inc = staging.stg_delay_incidents(raw.delay_incidents)

    def materialise(df: DataFrame, layer: str, name: str) -> DataFrame:
        path = sinks.layer_path(store, layer, name)
        by_month = name in MART_SORT or layer == "aggregates"
        sinks.write_table(df, path, sort_by=MART_SORT.get(name), partition_by=FACT_PARTITION if by_month else None)
        return sinks.read_table(spark, path, df.schema).select(*df.columns)

    i_occ = intermediate.int_trip_occupancy(s_trips, s_routes)
    i_rev = intermediate.int_booking_revenue(s_bookings, s_routes)
    rollup = intermediate.incident_rollup(s_inc)
    d_cats = dims.dim_delay_categories(s_inc)
    d_date = calendar.dim_date(spark, date_start, date_end)
    lazy = {
        "dim_routes": dims.dim_routes(s_routes),
        "dim_vehicles": dims.dim_vehicles(s_vehicles),
        "dim_date": d_date,
        "dim_delay_categories": d_cats,
        "fct_trips": marts.fct_trips(i_occ),
        "fct_revenue": marts.fct_revenue(i_rev),
        "feedback": feedback.typed_events(raw.feedback_events),
    }
    fixed = dict(
        stg_routes=s_routes,
        stg_vehicles=s_vehicles,
        stg_trips=s_trips,
        stg_bookings=s_bookings,
        stg_punctuality_trips=s_ptrips,
        stg_scheduled_trips=s_sched,
        stg_delay_incidents=s_inc,
        quarantined_incidents=staging.quarantined_incidents(raw.delay_incidents),
        quarantined_schedules=staging.quarantined_schedules(raw.scheduled_trips),
        int_trip_occupancy=i_occ,
        int_booking_revenue=i_rev,
        incident_rollup=rollup,
        feedback_events=raw.feedback_events,
        rejected_feedback=feedback.rejected_events(raw.feedback_events),
        store=store,
    )
    if not store:
        i_punct = intermediate.int_trip_punctuality(s_sched, s_ptrips, s_inc, s_routes, rollup=rollup)
        return Warehouse(**fixed, **lazy, int_trip_punctuality=i_punct, fct_punctuality=marts.fct_punctuality(i_punct))

    # The rows that the facts are made from are counted while they are read.
    not_done = {"not completed": ~F.col("trip_status").eqNullSafe("completed")}
    bad = {QUARANTINED: F.col("_unparsed") != ""}
    counted: dict[str, list[tuple[str, str, int]]] = {}

    def stage(df: DataFrame, name: str) -> DataFrame:
        return materialise(df, "intermediate", name)

    def mart(name: str) -> Callable[[Warehouse], DataFrame]:
        return lambda wh: materialise(lazy[name], "marts", name)

    def trips(wh: Warehouse) -> DataFrame:
        read = Reconciliation()
        done = read.watch("trips", s_trips, not_done)
        out = materialise(marts.fct_trips(intermediate.int_trip_occupancy(done, s_routes)), "marts", "fct_trips")
        counted["fct_trips"] = read.counts()
        return out

    def revenue(wh: Warehouse) -> DataFrame:
        read = Reconciliation()
        used = read.watch("bookings", s_bookings, {})
        out = materialise(marts.fct_revenue(intermediate.int_booking_revenue(used, s_routes)), "marts", "fct_revenue")
        counted["fct_revenue"] = read.counts()
        return out

    def assessed_trips(wh: Warehouse) -> DataFrame:
        read = Reconciliation()
        done = read.watch("punctuality_trips", s_ptrips, not_done)
        sched = read.watch("scheduled_trips", staging.read_schedules(raw.scheduled_trips), bad | {"invalid schedule": F.col("_is_invalid_schedule")})
        inc = read.watch("delay_incidents", staging.read_incidents(raw.delay_incidents), bad | {"invalid record": F.col("_is_invalid_record")})
        made = intermediate.int_trip_punctuality(sched, done, inc, s_routes, rollup=intermediate.incident_rollup(inc), stage=stage)
        # Trips of a route lie together, in the files and in the exchange of the fact, which packs them better.
        out = stage(made.sortWithinPartitions("route_id", "trip_date"), "int_trip_punctuality")
        counted["int_trip_punctuality"] = read.counts()
        return out

    def punctuality(wh: Warehouse) -> DataFrame:
        ip = wh.int_trip_punctuality
        # A table, so that its size is known when the fact is planned and the trips don't move to meet it.
        benchmarks = stage(marts.route_benchmarks(ip, stage), "route_benchmarks")
        return materialise(marts.fct_punctuality(ip, benchmarks), "marts", "fct_punctuality")

    def reconciled(wh: Warehouse) -> list[tuple[str, str, int]]:
        watched = ("fct_trips", "fct_revenue", "int_trip_punctuality")
        for name in watched:
            getattr(wh, name)
        return [row for name in watched for row in counted[name]]

    makers = {name: mart(name) for name in lazy} | {
        "fct_trips": trips,
        "fct_revenue": revenue,
        "int_trip_punctuality": assessed_trips,
        "fct_punctuality": punctuality,
        "reconciliation": reconciled,
    }
    wh = OnDemandWarehouse(fixed, makers)

    def part(key: tuple[str, str], table: str) -> Callable[[], StoredParts]:
        def make() -> StoredParts:
            rows, days = getattr(wh, table), wh.dim_date
            return StoredParts(materialise(metric_parts({table: rows}, days)[key][1], "aggregates", "_".join(key)), rows, days)

        return make

    wh.aggregates = _PartsOnDemand({key: part(key, table) for key, table in _part_tables().items()})
    if not on_demand:
        wh.make_all()
    return wh


def _part_tables() -> dict[tuple[str, str], str]:
    """The facts, by warehouse table, of the aggregates of both semantic models."""
    from routecast.plans import aggregates, semantic

    return {(m.name, f): m.tables[f][0] for m in (semantic.OPERATIONS, semantic.PUNCTUALITY) for f in aggregates.fact_tables(m)}


def metric_parts(facts: dict[str, DataFrame], dim_date: DataFrame) -> dict[tuple[str, str], tuple[str, DataFrame]]:
    """The aggregates of both semantic models over these facts, with the fact's name."""
    from routecast.plans import aggregates, semantic

    return aggregates.build_all([semantic.OPERATIONS, semantic.PUNCTUALITY], facts, dim_date)


_memo: dict[tuple[str, str, bool, str], Warehouse] = {}


def _version(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files, through Spark's own file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(conf)
    found = []
    for name in testdata.BOUND_TABLES:
        at = jvm.org.apache.hadoop.fs.Path(root, f"{name}.parquet")
        found += [f"{s.getPath().getName()}|{s.getLen()}|{s.getModificationTime()}" for s in fs.listStatus(at)]
    return "\n".join(found)


def warehouse_for(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Warehouse:
    """Warehouse of the test binding for ``sf_dir``, one per session and version
    of the input files; its tables are written when they are first read.

    With ``materialize`` the marts are written under the session's shared
    scratch folder (``spark.checkpoint.dir``). The folder is named after the
    application and the input, and is deleted when the driver process ends."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), materialize, _version(spark, sf_dir))
    if key not in _memo:
        store = None
        if materialize:
            tag = hashlib.sha1("|".join(map(str, key)).encode()).hexdigest()[:12]
            store = f"{scratch_dir(spark)}/routecast-{tag}"
            sinks.remove_at_exit(spark, store)
        _memo[key] = build_warehouse(spark, testdata.bind(spark, sf_dir), testdata.DATE_START, testdata.DATE_END, store, on_demand=True)
    return _memo[key]
