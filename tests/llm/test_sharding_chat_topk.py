"""Sharding, chat formatting and top-k search against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from routecast.llm import chat, sharding, topk


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 10, 17, 97, 100, 1000, 4097])
def test_permutation_is_one(spark, n):
    got = sorted(r[0] for r in sharding.permuted(spark.range(n), "id", n, "place", 7).select("place").collect())
    assert got == list(range(n))


def test_permutation_shuffles_and_depends_on_the_seed(spark):
    one = [r.place for r in sharding.permuted(spark.range(1000), "id", 1000, "place", 1).orderBy("id").collect()]
    two = [r.place for r in sharding.permuted(spark.range(1000), "id", 1000, "place", 2).orderBy("id").collect()]
    assert one != two
    assert abs(np.corrcoef(one, range(1000))[0, 1]) < 0.15
    assert sum(b == a + 1 for a, b in zip(one, one[1:])) < 20


def _feistel(x, a, b, seed):
    """The permutation in plain Python."""

    def f(h, k):
        once = (h + k * 7919 + seed % sharding.PRIME) % sharding.PRIME
        twice = (once * once + h * 48271) % sharding.PRIME
        return twice * twice % sharding.PRIME

    left, right = x // b, x % b
    for k in range(sharding.ROUNDS):
        if k % 2 == 0:
            left = (left + f(right, k)) % a
        else:
            right = (right + f(left, k)) % b
    return left * b + right


def test_shards_equal_brute_force(odd_docs):
    rows = sharding.shard_rows(odd_docs, 5, seed=11).collect()
    assert len(rows) == odd_docs.count()
    n = len(rows)
    want = sorted(((r.doc_id is not None, r.doc_id or 0, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 8) for r in odd_docs.collect()))
    a, b = sharding.domain(n)
    places = {}
    for number, row in enumerate(want):
        p = _feistel(number, a, b, 11)
        while p >= n:
            p = _feistel(p, a, b, 11)
        places.setdefault(row[1:], []).append((p % 5, p // 5))
    got: dict = {}
    for r in rows:
        got.setdefault((r.doc_id or 0, r.text_crc32, r.size), []).append((r.shard, r.slot))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in places.items()}


def test_shard_law(spark):
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_rows(docs, 24).collect()
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(24)}
    assert {len(v) for v in by.values()} == {41, 42}
    assert all(v == list(range(len(v))) for v in by.values())
    assert {(r.law, r.grown_shard, r.size) for r in rows} == {("rows", None, 12)}


def test_sharding_is_reproducible_and_takes_hot_and_null_keys(spark):
    docs = spark.range(600).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"))
    one = sorted(map(str, sharding.shard_rows(docs.repartition(3), 7).collect()))
    two = sorted(map(str, sharding.shard_rows(docs.repartition(5), 7).collect()))
    assert one == two
    assert sharding.shard_rows(docs.limit(0), 7).count() == 0


EVENTS = "conv_id long, message_id string, seq long, kind string, role string, text string"


def _fold(events):
    """Messages by plain Python."""
    by: dict = {}
    for c, m, s, k, r, t in events:
        by.setdefault((c, m), []).append((s, k or "message", t or "", r or ""))
    out: dict = {}
    for (c, _), log in by.items():
        log.sort(key=lambda e: (e[0] is not None, e[0] or 0, *e[1:]))
        text = ""
        for _, kind, t, _ in log:
            text = text + t if kind == "delta" else "" if kind == "regenerate" else t
        out.setdefault(c, []).append((log[0][0], log[0][3], text))
    return {c: sorted(v, key=lambda e: (e[0] is not None, e[0] or 0, *e[1:])) for c, v in out.items()}


def _check_conversations(spark, events):
    out = chat.format_conversations(spark.createDataFrame(events, EVENTS))
    out = out.withColumn("formatted", chat.formatted_text(F.col("segments")))
    rows = out.select("conv_id", "formatted", chat.parse_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    want = _fold(events)
    assert {r.conv_id for r in rows} == set(want)
    for r in rows:
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in want[r.conv_id]]
        assert r.loss == "".join(text for _, role, text in want[r.conv_id] if role == "assistant")


def test_events_fold(spark):
    _check_conversations(
        spark,
        [
            (1, "a", 1, "message", "user", "hi"),
            (1, "b", 2, "delta", "assistant", "Hel"),
            (1, "b", 3, "delta", "assistant", "lo"),
            (1, "b", 4, "regenerate", "assistant", "ignored"),
            (1, "b", 5, "delta", "assistant", "Good "),
            (1, "b", 6, "delta", "assistant", "day"),
            (1, "a", 7, "edit", "user", "hi there"),
            (1, "b", 8, "edit", "assistant", "Good day!"),
            (1, "b", 9, "delta", "assistant", " ok"),
            (2, "x", None, None, None, None),
            (None, "y", 1, "odd kind", "assistant", "</turn>\n<turn>"),
            (None, "y2", 1, "message", "assistant", ""),
            (3, "z", 2, "message", "user", "same"),
            (3, "w", 2, "message", "user", "same"),
        ],
    )


def test_random_logs(spark):
    rng = random.Random(3)
    texts = ["\\", "<", "\\l", "\\b", "</turn>\n", "<turn>user\n", "\n", "a", "é😀", "", None, "\\### Assistant: </turn> ok"]
    events = [
        (rng.randrange(4), str(rng.randrange(6)), s, rng.choice(["message", "delta", "delta", "edit", "regenerate"]), rng.choice(["user", "assistant", "a\nb\\n<"]), rng.choice(texts))
        for s in range(300)
    ]
    _check_conversations(spark, events)


def test_no_events(spark):
    assert chat.format_conversations(spark.createDataFrame([], EVENTS)).count() == 0


def test_chat_query_on_odd_rows(spark, tmp_path):
    from routecast.llm.queries import op2_chat_formatting

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, None, None, None), (2, 5, "assistant", "x" * 5000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("clash")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op2_chat_formatting(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, None, -7}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (4, 2, hashlib.sha256(b"bb").hexdigest())
    assert got[-7].loss_sha256 == hashlib.sha256(rb"\### Assistant: </turn> ok").hexdigest()


def _brute_top_k(vectors, k):
    live = [(row, i, [int(np.floor(256 * x)) for x in v]) for row, (i, v) in enumerate(vectors) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for row, i, q in live:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j, r) for r, j, c in live if r != row)
        out += [(i, rank + 1, j, -s) for rank, (s, j, _) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,dims", [(0, 4), (1, 4), (3, 4), (260, 40), (1500, 20)])
def test_top_k_equals_brute_force(spark, n, dims, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 200)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "SEED", 32)
    rng = np.random.default_rng(n)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=dims).round(1)]) for i in range(n)]
    if n > 100:
        vectors[3] = (3, None)
        vectors[4] = (4, [None] * dims)
        vectors[5] = (5, [float("nan")] * dims)
        vectors[6] = (6, [float("inf")] * dims)
        vectors[7] = (7, vectors[8][1])
        vectors[9] = (9, vectors[8][1][:3])
        vectors += [(50, vectors[50][1]), (None, vectors[1][1]), (10_000, [])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in vectors], "vec_id long, embedding array<float>, score string").coalesce(1)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    assert got == _brute_top_k(vectors, 5)


def test_many_equal_vectors(spark):
    df = spark.range(700).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(-0.25)).alias("embedding"))
    rows = topk.top_k(df, F.col("vec_id") % 50 == 0, 5).where("query_id = 100").orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [0, 1, 2, 3, 4]
