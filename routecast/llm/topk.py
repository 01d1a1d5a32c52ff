"""Exact top-k inner products: columnar branch-and-bound over blocks of vectors.

Vectors are packed into blocks of bounded size. Every block of candidates
meets every block of queries (a stated query set against all rows, in
blocks). Inside such a cell the candidates lie in vertical layout, one array
per dimension. Scores are summed one block of dimensions at a time; after each
block the Cauchy-Schwarz bound on the remaining dimensions tells which
candidates no query of the block can still want, and the survivors are
compacted before the next block of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routecast.llm import store

#: Rows of a candidate block and of a query block, and dimensions of a dimension block.
CANDIDATES, QUERIES, DIMENSIONS = 2048, 256, 16
#: Bytes of a block's matrix: blocks of very long vectors have fewer rows.
BLOCK_BYTES = 8 << 20
#: Scores are exact in float64 below EXACT; larger ones are summed from parts of LIMB bits, at most so many dimensions at a time.
EXACT, LIMB, LIMB_DIMENSIONS = 2.0**53, 20, 4096
#: Candidates that are scored in full first, to have a threshold for the others.
SEED = 256


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; an error where that has more than 64 bits."""
    scaled = lambda x: x.cast("double") * F.lit(float(scale))
    wide = F.raise_error(F.lit("a scaled vector component has more than 64 bits")).cast("long")
    return F.transform(vector, lambda x: F.when(F.abs(scaled(x)) < F.lit(2.0**63), F.floor(scaled(x)).cast("long")).otherwise(wide))


def usable(vector: Column) -> Column:
    """Whether a vector is not null and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def blocks(vectors: DataFrame, rows: int, dims: int) -> DataFrame:
    """``block``, ``ids`` and ``matrix``: blocks of at most ``rows`` vectors as row-major 64-bit integers.

    ``vectors``: row (unique long), id, ints. Narrow: each task packs its own
    rows, so nothing is gathered by a key.
    """

    rows = max(1, min(rows, BLOCK_BYTES // (8 * max(1, dims))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                m = np.zeros((part.num_rows, dims), np.int64)
                ints = part.column(2)
                sizes = np.diff(ints.offsets.to_numpy())
                flat = ints.flatten().to_numpy(zero_copy_only=False)
                r = np.repeat(np.arange(part.num_rows), sizes)
                c = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                m[r, c] = flat
                row = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(row[0])]), pa.array([row.astype("<i8").tobytes()]), pa.array([part.column(1).to_numpy().astype("<i8").tobytes()]), pa.array([m.tobytes()])],
                    names=["block", "rows", "ids", "matrix"],
                )

    return vectors.mapInArrow(run, "block long, rows binary, ids binary, matrix binary")


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of one query with each row of ``c``, as Python integers of any size.

    Components are cut into parts of ``LIMB`` bits; products of parts are exact
    in float64 over ``LIMB_DIMENSIONS`` dimensions, and their sums are Python's."""

    def parts(x: np.ndarray) -> list[np.ndarray]:
        out = []
        while x.any() and len(out) < 3:
            out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
            x = x >> LIMB  # the sign goes with the highest part
        return [*out, x.astype(np.float64)]

    total = np.zeros(len(c), object)
    for lo in range(0, c.shape[1], LIMB_DIMENSIONS):
        hi = lo + LIMB_DIMENSIONS
        for i, a in enumerate(parts(q[lo:hi])):
            for j, b in enumerate(parts(c[:, lo:hi])):
                total += (b @ a).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def best_in_cell(q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query in one cell: query index, candidate index, score.

    Below 2**53 in magnitude (no score and no partial sum exceeds the product of
    the norms) float64 is exact, and so are all comparisons. Beyond, candidates
    are kept as long as the rounding error lets them, and the kept ones' scores
    are computed exactly. The bound is rounded up. Ties go to the smaller id. A
    score of the k best that has more than 64 bits is an error.
    """
    whole_q, whole_c = q, c
    q, c = q.astype(np.float64), c.astype(np.float64).T  # vertical: one row per dimension
    dims = c.shape[0]
    norms = np.sqrt(np.einsum("dc,dc->c", c, c))
    q_norms = np.sqrt(np.einsum("qd,qd->q", q, q))
    largest = norms.max(initial=0) * q_norms.max(initial=0)
    # How far a sum in float64 may be off, for each query; nothing where all is exact.
    off = np.zeros(len(q)) if largest < EXACT / 2 else (dims + 8) * 2.0**-51 * q_norms * norms.max(initial=0)
    order = np.argsort(-norms, kind="stable")
    seed, rest = order[:SEED], order[SEED:]
    scores = q @ c[:, seed]
    scores[q_rows[:, None] == c_rows[seed][None, :]] = -np.inf
    floor = np.partition(scores, len(seed) - k, axis=1)[:, len(seed) - k] - 2 * off if len(seed) >= k else np.full(len(q), -np.inf)
    qi, ci = np.nonzero(scores >= np.maximum(floor, -1e300)[:, None])
    got_q, got_c, got_s = [qi], [seed[ci]], [scores[qi, ci]]
    if len(rest):
        alive = rest
        total = np.zeros((len(q), len(alive)))
        q_mass = np.sqrt(np.cumsum((q**2)[:, ::-1], axis=1)[:, ::-1])
        c_mass = np.sqrt(np.cumsum((c[:, alive] ** 2)[::-1], axis=0)[::-1])
        for d in range(0, dims, DIMENSIONS):
            total += q[:, d : d + DIMENSIONS] @ c[d : d + DIMENSIONS, alive]
            after = d + DIMENSIONS
            if after >= dims:
                break
            bound = total + q_mass[:, after : after + 1] * c_mass[after][None, :] * (1 + 1e-9) + 1e-6
            keep = (bound >= floor[:, None]).any(axis=0)
            if not keep.all():  # compact the survivors
                alive, total, c_mass = alive[keep], total[:, keep], c_mass[:, keep]
        total[q_rows[:, None] == c_rows[alive][None, :]] = -np.inf
        qi, ci = np.nonzero(total >= np.maximum(floor, -1e300)[:, None])
        got_q.append(qi)
        got_c.append(alive[ci])
        got_s.append(total[qi, ci])
    qi, ci, s = np.concatenate(got_q), np.concatenate(got_c), np.concatenate(got_s)
    real = np.isfinite(s)
    qi, ci, s = qi[real], ci[real], s[real]
    if not off.any():
        by = np.lexsort((c_ids[ci], -s, qi))
        qi, ci, s = qi[by], ci[by], s[by].astype(np.int64)
        first = np.searchsorted(qi, np.arange(len(q)))
        top = np.arange(len(qi)) - first[qi] < k
        return qi[top], ci[top], s[top]
    out: list[tuple[int, int, int]] = []
    for i in range(len(q)):
        own, near = ci[qi == i], s[qi == i]
        if len(own) > k:  # surely worse than k others, though not exactly known
            own = own[near >= np.partition(near, len(near) - k)[len(near) - k] - 2 * off[i]]
        exact = exact_scores(whole_q[i], whole_c[own])
        best = sorted(zip((-x for x in exact), c_ids[own].tolist(), own.tolist()))[:k]
        if any(abs(x) >= 1 << 63 for x, _, _ in best):
            raise OverflowError("a score has more than 64 bits")
        out += [(i, place, -x) for x, _, place in best]
    return tuple(np.array([r[j] for r in out], np.int64) for j in range(3))


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best rows of every query row by integer inner product: ``query_id``, ``rank``, the key, ``score``.

    Queries are the rows for which ``is_query`` holds; candidates are all rows
    but the query's own. Ties go to the smaller key. Fewer than k candidates:
    all of them.

    The query blocks are copied to groups of candidate blocks by an equi-join
    on the group (fragment and replicate): a task holds one block of each, of
    at most ``BLOCK_BYTES``, and nothing is broadcast or collected. A cell returns at most k rows a query;
    a window keeps the k best of them.

    Components and scores are 64-bit integers, exact in all their range; a
    scaled component, or a score among a cell's k best, that has more bits ends
    the job with an error.

    Vectors that are null or hold null or non-finite components, and rows
    without a key, take no part. A shorter vector counts as filled up with
    zeros. Rows with equal keys are separate rows: each is a query of its own
    under the same ``query_id`` and a candidate of the other. No rows, or no
    queries, give no rows. Other columns are left out.
    """
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("ints"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = store.written(rows, "vectors")
    sizes = rows.agg(F.max(F.size("ints")), F.count("*")).first()
    dims, n = int(sizes[0] or 0), int(sizes[1])
    groups = max(1, -(-n // (4 * CANDIDATES)))
    c = blocks(rows.select("row", "id", "ints"), CANDIDATES, dims)
    c = c.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("grp"), F.col("rows").alias("c_rows"), F.col("ids").alias("c_ids"), F.col("matrix").alias("c"))
    q = blocks(rows.where("asks").select("row", "id", "ints").coalesce(max(1, -(-n // 50_000))), QUERIES, dims)
    q = q.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q"))
    cells = c.join(q, "grp").drop("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in range(batch.num_rows):
                x = {name: batch.column(i)[cell].as_buffer() for i, name in enumerate(batch.schema.names)}
                cr, ci = np.frombuffer(x["c_rows"], "<i8"), np.frombuffer(x["c_ids"], "<i8")
                qr, qi = np.frombuffer(x["q_rows"], "<i8"), np.frombuffer(x["q_ids"], "<i8")
                cm, qm = np.frombuffer(x["c"], "<i8").reshape(len(cr), -1), np.frombuffer(x["q"], "<i8").reshape(len(qr), -1)
                a, b, s = best_in_cell(qm, qr, cm, cr, ci, k)
                yield pa.RecordBatch.from_arrays([pa.array(qr[a]), pa.array(qi[a]), pa.array(cr[b]), pa.array(ci[b]), pa.array(s)], names=["q_row", "q_id", "c_row", "c_id", "score"])

    found = cells.mapInArrow(run, "q_row long, q_id long, c_row long, c_id long, score long")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("c_id"), F.col("c_row"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("q_id").alias("query_id"), "rank", F.col("c_id").alias(key), "score")
