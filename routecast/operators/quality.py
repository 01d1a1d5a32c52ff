"""Data-quality checks (D1-D5): the declared column tests as Spark jobs.

Each check returns the offending rows or keys (what a failing test would
show); ``dq_summary`` runs every declared test and returns one row per test
with its failure count. All checks are aggregates or anti-joins; what the
driver sees are counts.

Uniqueness is tested in two passes. The first sends an 8-byte fingerprint of
each value through the shuffle, and only fingerprints that occur more than
once are kept. The second reads the columns again and compares the values
behind those fingerprints exactly. A value that occurs once is never moved, and
two values that share a fingerprint are told apart.

Relationships to a large parent are tested behind a Bloom filter of its keys
(:func:`filtered_orphans`): children's rows aren't shuffled at all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecast.session import scratch_dir

#: Repeated fingerprints, 8 bytes each, that are broadcast; more are met by a shuffle.
BROADCAST_FINGERPRINTS = 1 << 20


def fingerprint(place: int, value: Column) -> Column:
    """8 bytes that stand for a value of the ``place``-th tested column."""
    return F.xxhash64(F.lit(place), value)


def _marked(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """``place``, ``value`` (as text) and ``mark`` of all non-NULL values of some columns: one pass, a row for each."""
    cells = [F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value"), fingerprint(i, F.col(c).cast("string")).alias("mark")) for i, c in columns.items()]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("value is not null")


def repeated_values(tables: list[tuple[DataFrame, dict[int, str]]]) -> DataFrame | None:
    """``place``, ``value`` and ``n`` of the values that occur more than once in their column; None if there are none.

    ``tables``: the columns of each table under numbers of their own. NULLs are
    left out. The repeated fingerprints are written (their number decides
    whether they are broadcast), so this runs a job."""
    marked = [_marked(df, columns) for df, columns in tables]
    marks = reduce(DataFrame.unionAll, [m.select("mark") for m in marked]).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    again = marks.filter("n > 1").select(F.col("mark").alias("again"))
    scratch_dir(again.sparkSession)  # names the folder of the checkpoint
    again = again.checkpoint()
    n = again.count()
    if not n:
        return None
    if n <= BROADCAST_FINGERPRINTS:
        again = F.broadcast(again)
    suspects = [m.join(again, F.col("mark") == F.col("again"), "left_semi") for m in marked]
    return reduce(DataFrame.unionAll, suspects).groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs ignored)."""
    found = repeated_values([(df, {0: column})])
    kind = df.schema[column].dataType
    if found is None:
        return df.select(column, F.lit(2).cast("long").alias("n_records")).limit(0)
    return found.select(F.col("value").cast(kind).alias(column), F.col("n").alias("n_records"))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def relationship_failures(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """D3: child rows whose non-NULL ``fk`` has no parent (anti-join)."""
    keys = parent.select(F.col(pk).alias("__pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("__pk"), "left_anti")


#: Bits of the filter for each parent key; bits set for a key, all in one word of 64.
BITS_A_KEY, BITS_SET = 16, 4
#: Words of the filter (8 bytes each) that go to every task; parents beyond that have none.
MOST_WORDS = 1 << 22


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """A key's word in the filter and its bits there."""
    h = F.xxhash64(key)
    word = F.pmod(h, F.lit(words))
    g = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    return word, reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(parent: DataFrame, pk: str) -> tuple[DataFrame, int] | None:
    """A Bloom filter of the parent's keys: one row with an array of 64-bit words, and their number.

    Built by aggregates: the keys' bits are merged by word in each task before
    the shuffle. None if the parent has too many keys for ``MOST_WORDS`` words,
    or none at all. Counts the parent's rows, so this runs a job."""
    n = parent.select(pk).count()
    words = max(1, math.ceil(n * BITS_A_KEY / 64))
    if not n or words > MOST_WORDS:
        return None
    word, bits = _place(F.col(pk), words)
    merged = parent.filter(F.col(pk).isNotNull()).select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = parent.sparkSession.range(words).select(F.col("id").alias("word")).join(merged, "word", "left")
    row = every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("all"))
    return row.select(F.transform("all", lambda x: x["bits"]).alias("words")), words


def _inside(key: Column, made: tuple[DataFrame, int]) -> Column:
    """Whether a key may be in a filter (:func:`key_filter`): true for all that are."""
    row, words = made
    word, bits = _place(key, words)
    return F.element_at(row.scalar(), (word + 1).cast("int")).bitwiseAND(bits) == bits


def may_match(child: DataFrame, fk: str, made: tuple[DataFrame, int] | None) -> DataFrame:
    """Child rows that may have a parent: all that have one, and few others; all rows where there is no filter."""
    return child if made is None else child.filter(_inside(F.col(fk), made))


def filtered_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """D3 for a large parent: child rows whose non-NULL ``fk`` has no parent.

    A key outside the parent's Bloom filter is an orphan for sure. Keys inside
    it are proven exactly, each once: of the children only their distinct keys
    are shuffled (merged in each task first) and anti-joined with the parent.
    The few false positives found are then looked up among the children. No
    child row is shuffled, whether it matches or not, as long as they are few.

    A parent that is too large for a filter has all its children's distinct
    keys proven in the same way."""
    known = child.filter(F.col(fk).isNotNull())
    made = key_filter(parent, pk)
    keys = parent.select(F.col(pk).alias("__pk"))
    inside = F.lit(True) if made is None else _inside(F.col(fk), made)
    told = known.withColumn("__inside", inside)
    proven = told.filter("__inside").select(F.col(fk).alias("__fk")).distinct().join(keys, F.col("__fk") == F.col("__pk"), "left_anti")
    scratch_dir(child.sparkSession)  # names the folder of the checkpoint
    proven = proven.checkpoint()
    if proven.count() <= BROADCAST_FINGERPRINTS:
        proven = F.broadcast(proven)
    outside = told.filter("not __inside").drop("__inside")
    slipped = told.filter("__inside").drop("__inside").join(proven, F.col(fk) == F.col("__fk"), "left_semi")
    return outside.unionByName(slipped)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # unique | not_null | relationships | quarantine
    parent: str | None = None
    parent_column: str | None = None


def _u_n(model: str, column: str) -> list[Check]:
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


# The declared tests (18 unique, 27 not_null, 8 relationships). The binding
# has two executed-trip relations (operations and punctuality); the trip
# tests apply to both, and schedules reference the punctuality trips. The two
# quarantines of staging are counted beside them.
DECLARED_CHECKS: list[Check] = [
    *_u_n("stg_routes", "route_id"),
    *_u_n("stg_vehicles", "vehicle_id"),
    *_u_n("stg_trips", "trip_id"),
    Check("stg_trips", "route_id", "not_null"),
    *_u_n("stg_punctuality_trips", "trip_id"),
    Check("stg_punctuality_trips", "route_id", "not_null"),
    *_u_n("stg_bookings", "booking_id"),
    Check("stg_bookings", "route_id", "not_null"),
    *_u_n("stg_scheduled_trips", "scheduled_trip_id"),
    *_u_n("stg_scheduled_trips", "trip_id"),
    Check("stg_scheduled_trips", "trip_id", "relationships", "stg_punctuality_trips", "trip_id"),
    *_u_n("stg_delay_incidents", "incident_id"),
    Check("stg_delay_incidents", "trip_id", "not_null"),
    *_u_n("int_trip_occupancy", "trip_id"),
    *_u_n("int_booking_revenue", "booking_id"),
    *_u_n("int_trip_punctuality", "trip_id"),
    *_u_n("dim_routes", "route_id"),
    *_u_n("dim_vehicles", "vehicle_id"),
    *_u_n("dim_date", "date_key"),
    *_u_n("fct_trips", "trip_id"),
    Check("fct_trips", "route_id", "not_null"),
    Check("fct_trips", "route_id", "relationships", "dim_routes", "route_id"),
    Check("fct_trips", "vehicle_id", "relationships", "dim_vehicles", "vehicle_id"),
    Check("fct_trips", "date_key", "not_null"),
    Check("fct_trips", "date_key", "relationships", "dim_date", "date_key"),
    *_u_n("fct_revenue", "booking_id"),
    Check("fct_revenue", "route_id", "not_null"),
    Check("fct_revenue", "route_id", "relationships", "dim_routes", "route_id"),
    Check("fct_revenue", "date_key", "not_null"),
    *_u_n("fct_punctuality", "trip_id"),
    Check("fct_punctuality", "route_id", "not_null"),
    Check("fct_punctuality", "route_id", "relationships", "dim_routes", "route_id"),
    Check("fct_punctuality", "vehicle_id", "relationships", "dim_vehicles", "vehicle_id"),
    Check("fct_punctuality", "date_key", "not_null"),
    Check("fct_punctuality", "date_key", "relationships", "dim_date", "date_key"),
    *_u_n("dim_delay_categories", "delay_category_key"),
    *_u_n("dim_delay_categories", "delay_category"),
    Check("quarantined_incidents", "unparsed_columns", "quarantine"),
    Check("quarantined_schedules", "unparsed_columns", "quarantine"),
]


def _cells(df: DataFrame, model: str, column: str, test: str) -> DataFrame:
    """One labelled row for each row of ``df``."""
    return df.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"))


def _nulls(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """A labelled row for each NULL in ``columns``: one pass, and nothing for rows without one."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    return df.select(F.explode(missing).alias("column_name")).select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"))


def dq_summary(tables: dict[str, DataFrame], checks: list[Check] = DECLARED_CHECKS) -> DataFrame:
    """One row per declared test with its number of failures, and one per
    quarantine with its number of rows.

    Unique columns of all tables are tested together: their values' 8-byte
    fingerprints meet in one aggregation, and only values whose fingerprint
    repeats are compared (:func:`repeated_values`). All columns' NULLs are
    counted in one pass a table, which shuffles nothing but a failure.
    Relationships are anti-joins. All failures are counted in one aggregation,
    after a count in each task. The declared tests are a small table that the
    counts join, so a test over an empty table reports 0.
    """
    spark = next(iter(tables.values())).sparkSession
    unique: dict[str, dict[int, str]] = {}
    nulls: dict[str, list[str]] = {}
    failures = []
    for i, c in enumerate(checks):
        if c.test == "unique":
            unique.setdefault(c.model, {})[i] = c.column
        elif c.test == "not_null":
            nulls.setdefault(c.model, []).append(c.column)
        elif c.test == "relationships":
            orphans = relationship_failures(tables[c.model], c.column, tables[c.parent], c.parent_column)
            failures.append(_cells(orphans, c.model, c.column, c.test))
        elif c.test == "quarantine":
            failures.append(_cells(tables[c.model], c.model, c.column, c.test))
    failures += [_nulls(tables[m], m, columns) for m, columns in nulls.items()]
    declared = spark.createDataFrame([(i, c.model, c.column, c.test) for i, c in enumerate(checks)], "place int, model string, column_name string, test string")
    found = reduce(DataFrame.unionByName, failures).groupBy("model", "column_name", "test").agg(F.count(F.lit(1)).alias("failures")) if failures else None
    out = declared.withColumn("failures", F.lit(None).cast("long")) if found is None else declared.join(found, ["model", "column_name", "test"], "left")
    repeated = repeated_values([(tables[m], columns) for m, columns in unique.items()]) if unique else None
    if repeated is not None:
        values = repeated.groupBy("place").agg(F.count(F.lit(1)).alias("values"))
        out = out.join(values, "place", "left").withColumn("failures", F.coalesce("failures", "values"))
    return out.select("model", "column_name", "test", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))
