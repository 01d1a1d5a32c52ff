"""Time helpers that never depend on the session time zone.

All event times are ``timestamp_ntz``. ``date_trunc`` on an NTZ value
returns a zone-aware timestamp, so minute arithmetic here goes through exact
microseconds since a fixed NTZ epoch instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_MICROS_PER_MINUTE = 60_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(col: Column | str) -> Column:
    """Cast to ``timestamp_ntz`` (no-op for NTZ input)."""
    return _c(col).cast("timestamp_ntz")


def epoch_micros(col: Column | str) -> Column:
    """Exact microseconds since 1970-01-01 00:00:00 (wall clock)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ntz(col))


def _minute_index(col: Column | str) -> Column:
    """Minutes since 1970-01-01 00:00 (floor), time-zone independent.

    From 1970 on, ``unix_timestamp`` of an NTZ value (whole seconds,
    truncated, which equals floor there) gives it at ~1/4 of the cost of
    ``timestamp_diff``; earlier values take the exact microsecond path,
    where truncation toward zero would be off by one."""
    c = ntz(col)
    fast = F.floor(F.unix_timestamp(c) / F.lit(60))
    us = epoch_micros(c)
    exact = (us - F.pmod(us, F.lit(_MICROS_PER_MINUTE))) / F.lit(_MICROS_PER_MINUTE)
    return F.when(c >= F.expr(_EPOCH), fast).otherwise(exact)


def minute_diff(start: Column | str, end: Column | str) -> Column:
    """Number of minute *boundaries* crossed from ``start`` to ``end``.

    10:00:50 -> 10:01:10 is 1; 10:00:10 -> 10:00:50 is 0; negative when
    ``end`` is earlier; NULL if either side is NULL. Returns ``bigint``.
    """
    return (_minute_index(end) - _minute_index(start)).cast("long")


def dow0(col: Column | str) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(col)) - F.lit(1)).cast("int")


def add_seconds(col: Column | str, seconds: Column | int) -> Column:
    n = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_add("SECOND", n, ntz(col))


def add_minutes(col: Column | str, minutes: Column | int) -> Column:
    n = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return F.timestamp_add("MINUTE", n, ntz(col))
