"""Arithmetic helpers with the source dialect's NULL and rounding rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str | int | float) -> Column:
    if isinstance(col, Column):
        return col
    if isinstance(col, str):
        return F.col(col)
    return F.lit(col)


def dec(value: str, precision: int = 10, scale: int | None = None) -> Column:
    """A decimal literal (Python floats would silently become doubles)."""
    d = Decimal(value)
    if scale is None:
        scale = max(0, -d.as_tuple().exponent)
    return F.lit(d).cast(f"decimal({precision},{scale})")


def strict_greatest(*cols: Column | str | int) -> Column:
    """``greatest`` that is NULL as soon as one argument is NULL."""
    cs = [_c(c) for c in cols]
    cond = cs[0].isNotNull()
    for c in cs[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.greatest(*cs))


def strict_least(*cols: Column | str | int) -> Column:
    """``least`` that is NULL as soon as one argument is NULL."""
    cs = [_c(c) for c in cols]
    cond = cs[0].isNotNull()
    for c in cs[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.least(*cs))


def round_half_up_int(col: Column | str) -> Column:
    """``x::integer`` of the source dialect: round half away from zero.

    The input must be exact (integer or decimal); the cast alone would
    truncate.
    """
    return F.round(_c(col), 0).cast("int")


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(den, 0)``."""
    d = _c(den)
    return _c(num) / F.when(d != 0, d)


def rate(cond: Column) -> Column:
    """Share of rows where ``cond`` is true, as a double.

    ``avg(case when cond then 1.0 else 0.0 end)`` written so that it stays a
    double (Spark would type the literal form as a 6-digit decimal) and is
    NULL, not an error, on an empty input.
    """
    n = F.count(F.lit(1))
    return F.count_if(cond).cast("double") / F.when(n != 0, n).cast("double")


def avg_exact(col: Column | str) -> Column:
    """Average of a decimal column as double: exact sum, one rounding."""
    c = _c(col)
    n = F.count(c)
    return F.sum(c).cast("double") / F.when(n != 0, n).cast("double")
