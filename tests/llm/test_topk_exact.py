"""Exact scores of vectors whose products pass what float64 can hold."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F
from routecast.llm import topk


def _brute(q, q_rows, c, c_rows, c_ids, k):
    out = []
    for i, row in enumerate(q.tolist()):
        scored = sorted((-sum(a * b for a, b in zip(row, other)), c_ids[j], j) for j, other in enumerate(c.tolist()) if c_rows[j] != q_rows[i])
        out += [(i, j, -s) for s, _, j in scored[:k]]
    return sorted(out)


@pytest.mark.parametrize("high", [50, 1 << 20, 1 << 28, 1 << 29])
def test_cells_equal_python_integers(high):
    random = np.random.default_rng(high)
    for dims in (1, 2, 7, 40):
        top = min(high, int((2**62 / dims) ** 0.5))
        c = random.integers(-top, top + 1, (700, dims))
        c[1::3] = c[0] + random.integers(-1, 2, c[1::3].shape)  # near the best, apart by the last bits
        q = np.concatenate([c[:1], random.integers(-top, top + 1, (4, dims)), np.zeros((1, dims), np.int64)])
        ids = random.permutation(1000)[:700]
        rows = np.arange(700)
        q_rows = np.array([0, -1, -2, -3, -4, -5])
        got = topk.best_in_cell(q, q_rows, c, rows, ids, 5)
        assert sorted(zip(*(x.tolist() for x in got))) == _brute(q, q_rows, c, rows, ids, 5)


def test_products_beyond_float64():
    q = np.array([[1 << 28, 1]])
    c = np.array([[1 << 28, 1], [1 << 28, 5]])
    _, place, score = topk.best_in_cell(q, np.array([9]), c, np.array([0, 1]), np.array([7, 8]), 2)
    assert place.tolist() == [1, 0] and score.tolist() == [(1 << 56) + 5, (1 << 56) + 1]
    assert topk.exact_scores(np.array([-(1 << 62), 3]), np.array([[1 << 62, -5], [-(1 << 62), 1 << 40]])).tolist() == [-(1 << 124) - 15, (1 << 124) + (3 << 40)]
    with pytest.raises(OverflowError):
        topk.best_in_cell(np.array([[1 << 40]]), np.array([9]), np.array([[1 << 40]]), np.array([0]), np.array([7]), 2)


def test_large_components_through_the_operator(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 5.0]), (2, [1e8, -1e8]), (50, [2.0**20, 0.00390625]), (51, [8e6] * 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: [int(256 * x) for x in v] for i, v in rows}
    want = []
    for q in (0, 50):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:3], 1)]
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 3).collect())) == want
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 3).collect()


def test_long_vectors_have_smaller_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 64)
    rows = spark.range(10).select(F.col("id").alias("row"), "id", F.array(F.col("id"), F.lit(1).cast("long")).alias("ints"))
    sizes = [len(bytes(r.ids)) // 8 for r in topk.blocks(rows, 2048, 2).collect()]
    assert sum(sizes) == 10 and max(sizes) <= 4
