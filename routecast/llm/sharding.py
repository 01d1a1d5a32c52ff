"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

DataFrame functions only. Rows are numbered 0..n-1 in (key, content) order; a
keyed permutation of 0..n-1 then gives each row a place ``p``, its shard
``p % shards`` and its slot ``p // shards``. Shard and slot of any row number
can be computed without the table, and shard sizes differ by one at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routecast.llm import store

ROUNDS = 6
#: Modulus of the round function: a prime below 2**31, so products stay in 64 bits.
PRIME = 2_147_483_647


def numbered(df: DataFrame, order: list[str], number: str) -> DataFrame:
    """``df`` with its rows numbered 0..n-1 in the given order (nulls first).

    One range shuffle; its result is written, since two runs of a range
    shuffle may cut the ranges differently. Ranges are of the order columns
    plus the row's place in its input, so a value that many rows share is
    split; rows equal in every order column are interchangeable. A number is
    the place in the range plus the rows of all ranges before, which is a
    table of one row per range (at most the session's shuffle partitions, so
    it is broadcast).
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    place = dealt.withColumn("_at", F.monotonically_increasing_id())
    place = place.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    table = store.written(place, "numbered")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = table.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    ranges = ranges.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = table.join(F.broadcast(ranges), F.col("_part") == F.col("_p"))
    return out.withColumn(number, F.col("_before") + F.col("_at")).drop("_p", "_part", "_at", "_before")


def domain(n: int) -> tuple[int, int]:
    """Sides a, b of the grid that is permuted: a * b >= n, with at most a numbers beyond n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _f(half: str, k: str, seed: int) -> str:
    """The keyed round function: two squarings modulo a prime."""
    once = f"(({half} + {k} * 7919 + {seed % PRIME}) % {PRIME})"
    twice = f"(({once} * {once} + {half} * 48271) % {PRIME})"
    return f"({twice} * {twice} % {PRIME})"


def _feistel(x: str, a: int, b: int, seed: int, tag: str) -> str:
    """A permutation of 0..a*b-1: the halves take turns, each shifted by a function of the other."""
    s, k = f"s{tag}", f"k{tag}"
    left = f"if({k} % 2 = 0, ({s}.l + {_f(f'{s}.r', k, seed)}) % {a}L, {s}.l)"
    right = f"if({k} % 2 = 1, ({s}.r + {_f(f'{s}.l', k, seed)}) % {b}L, {s}.r)"
    return (
        f"aggregate(sequence(0L, {ROUNDS - 1}L), named_struct('l', {x} div {b}L, 'r', {x} % {b}L), "
        f"({s}, {k}) -> named_struct('l', {left}, 'r', {right}), {s} -> {s}.l * {b}L + {s}.r)"
    )


def permuted(df: DataFrame, number: str, n: int, place: str, seed: int) -> DataFrame:
    """Adds ``place``: a permutation of 0..n-1 applied to ``number``.

    Cycle walking: a place beyond n is permuted again until it is inside. Each
    step of a walk visits another of the grid's at most ``a`` numbers beyond n,
    so that many steps always suffice. Only about one row in ``a`` walks at
    all, and the steps stay unevaluated for the others.
    """
    a, b = domain(n)
    once = df.withColumn("_once", F.expr(_feistel(number, a, b, seed, "")))
    if a * b > n:
        walk = f"aggregate(sequence(1, {a * b - n}), _once, (v, i) -> if(v < {n}L, v, {_feistel('v', a, b, seed, '2')}))"
        once = once.withColumn("_once", F.expr(f"if(_once < {n}L, _once, {walk})"))
    return once.withColumnRenamed("_once", place)


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8 for the length field."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long")


def shard_rows(docs: DataFrame, shards: int, seed: int = 20_240_917, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``key``, ``size``, ``text_crc32``, ``law`` (`rows`), ``shard``, ``slot`` and ``grown_shard`` (null).

    The law is `rows`: shard counts are at most one apart, and the slots of a
    shard run from 0 without gaps. Only narrow rows (no texts) are shuffled,
    once.

    Null text has size 8 and the CRC of no bytes; null keys come first. Rows
    with the same key, or entirely equal rows, are separate rows with places of
    their own. An empty table gives no rows. Other columns are left out.
    """
    narrow = docs.select(
        F.col(key).alias("key"),
        text_size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("_content"),
    )
    rows = numbered(narrow, ["key", "text_crc32", "size", "_content"], "_number")
    n = rows.count()
    placed = permuted(rows, "_number", n, "_place", seed)
    return placed.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
