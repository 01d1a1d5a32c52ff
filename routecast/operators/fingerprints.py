"""Fingerprints of rows and of tables by month.

A table's fingerprint for a month is its number of rows and three sums over
the pieces of a 64-bit hash of each row. It doesn't depend on the rows' order,
sees repeated rows, and needs one scan with partial aggregation and no row
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for rows without a month.
NO_MONTH = 0
_PIECE = 22  # bits of a hash that are summed together: 2^41 rows fit into a long
FINGERPRINT = ["n_rows", "h0", "h1", "h2"]


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns in which NULLs have a place: (NULL, 'a') differs from ('a', NULL)."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def fingerprints(df: DataFrame, month: Column | None = None) -> DataFrame:
    """``month_key`` and the fingerprint of the rows in each month; without ``month`` all rows are in none."""
    key = F.lit(NO_MONTH) if month is None else F.coalesce(month, F.lit(NO_MONTH))
    mask = F.lit((1 << _PIECE) - 1)
    hashed = df.select(key.cast("int").alias("month_key"), row_hash(df).alias("h"))
    pieces = [F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", _PIECE).bitwiseAND(mask), F.shiftrightunsigned("h", 2 * _PIECE)]
    return hashed.groupBy("month_key").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(p).alias(f"h{i}") for i, p in enumerate(pieces)])
