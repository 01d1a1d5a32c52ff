"""Lexical search, the quality classifier and periodic runs against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from routecast.llm import lexical_search, periodic_runs, quality_fm, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# -- lexical search ---------------------------------------------------------


def _terms(text):
    return TERM.findall((text or "").encode().translate(LOWER))


def _ranked(docs, items, k):
    """All scores of all documents, as the contract has them."""
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, words = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, c), n in zip(counts, sizes):
            m = 75 + (25 * n * n_docs) // max(1, words)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in _terms(text) if t in c)
            scores.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return sorted(out, key=str)


def _search(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("term", F.lit(2))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit("clash")).withColumn("score", F.lit(0))
    return sorted((tuple(r) for r in lexical_search.search(lexical_search.build_index(d), q, k).collect()), key=str)


def test_search_odd_cases(spark):
    docs = [(1, "The cat, the CAT; café 9"), (2, "the dog"), (2, "the dog"), (None, "the cat"), (5, None), (6, ""), (7, " ,;"), (8, "the cat"), (9, "nospace" * 300_000), (10, "x " * 300_000 + "cat")]
    items = [(1, "cat the Cat café"), (1, "dog"), (None, "cat"), (3, None), (4, ""), (5, "unseen"), (6, "nospace" * 300_000)]
    assert _search(spark, docs, items) == _ranked(docs, items, 20)
    assert [r[2] for r in _search(spark, docs, [(1, "cat")])] == [r[2] for r in _ranked(docs, [(1, "cat")], 20)]


def test_search_without_documents_or_queries(spark):
    assert _search(spark, [], [(1, "cat")]) == [] and _search(spark, [(1, "cat")], []) == []


def test_search_many_ties_and_small_shards(spark, monkeypatch):
    """Blocks, spans and shards of few documents; copies beyond k: the smallest keys stay."""
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    share = 1 / np.arange(1, 41)
    docs = [(int(i), " ".join(random.choice(words, random.integers(1, 60), p=share / share.sum()))) for i in random.permutation(900)]
    docs += [(10_000 + i, "w0 w1 w39 w39") for i in range(300)] + [(20_000 + i, "w3") for i in range(300)]
    items = [(i, " ".join(random.choice(words, 12))) for i in range(12)] + [(50, "w39 w1"), (51, "w3"), (52, " ".join(words))]
    want = _ranked(docs, items, 7)
    assert _search(spark, docs, items, 7) == want
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 20)
    assert _search(spark, docs, items, 7) == want


def test_block_max_maxscore_equals_exhaustive_scores():
    """Shards, blocks and spans of all sizes; and blocks stay packed that can't matter."""
    random = np.random.default_rng(11)
    for _ in range(30):
        n = int(random.integers(1, 3000))
        counter = lexical_search._Counter()
        lexical_docs = []
        for i in range(n):
            text = " ".join(f"w{int(x)}" for x in np.minimum(random.zipf(1.4, random.integers(0, 30)), 60))
            lexical_docs.append(text)
            counter.add(pa.array([i]), text.encode())
        tables = pa.Table.from_batches(list(counter.batches(0)))
        size = np.frombuffer(tables.column("sizes")[0].as_py(), "<i8")
        total = int(size.sum())
        of_size = lambda x: lexical_search.length_penalty(x, n, total)
        lists = {r["term"]: lexical_search._List(r["df"], r["blocks"], r["skyline"], r["postings"], of_size(size)) for r in tables.slice(1).to_pylist()}
        asked = [(lists[t], int(random.integers(1, 5000))) for t in lists if random.random() < 0.3]
        doc, score = lexical_search.best_in_shard(asked, of_size, n, 10)
        full = np.zeros(n, np.int64)
        for p, w in asked:
            d, g = p.between(0, n)
            full[d] += w * g
        best = np.lexsort((np.arange(n), -full))[:10]
        best = best[full[best] > 0]
        assert doc.tolist() == best.tolist() and score.tolist() == full[best].tolist()


def test_common_terms_blocks_stay_packed():
    """A rare term fills the k best; the common one's blocks without such documents are never unpacked."""
    counter = lexical_search._Counter()
    for i in range(20_000):
        counter.add(pa.array([i]), b"common rare" if i % 4000 == 0 else b"common other")
    tables = pa.Table.from_batches(list(counter.batches(0)))
    size = np.frombuffer(tables.column("sizes")[0].as_py(), "<i8")
    of_size = lambda x: lexical_search.length_penalty(x, 20_000, 40_000)
    lists = {r["term"]: lexical_search._List(r["df"], r["blocks"], r["skyline"], r["postings"], of_size(size)) for r in tables.slice(1).to_pylist()}
    doc, _ = lexical_search.best_in_shard([(lists[b"rare"], 8000), (lists[b"common"], 3)], of_size, 20_000, 2)
    assert doc.tolist() == [0, 4000]
    unpacked = sum(x is not None for x in lists[b"common"].unpacked)
    assert unpacked < 70 < len(lists[b"common"].unpacked)


# -- quality ----------------------------------------------------------------


def test_pairwise_term_is_the_sum_over_pairs():
    random = np.random.default_rng(5)
    linear, factors = random.normal(size=50), random.normal(size=(50, 4))
    ends = np.array([0, 6, 7, 19])
    column = np.concatenate([random.choice(50, n, replace=False) for n in np.diff(ends)])
    value = random.normal(size=19)
    got, _ = quality_fm._raw(linear, factors, 0.25, ends, column, value)
    for r in range(3):
        at = range(ends[r], ends[r + 1])
        pairs = sum(factors[column[i]] @ factors[column[j]] * value[i] * value[j] for i in at for j in at if i < j)
        assert got[r] == pytest.approx(0.25 + sum(linear[column[i]] * value[i] for i in at) + pairs)


def test_factors_learn_what_no_linear_model_can():
    """The label is 1 if exactly one of two marks is there."""
    random = np.random.default_rng(1)
    marks = random.integers(0, 2, (1500, 2))
    column = np.stack([marks[:, 0], 2 + marks[:, 1]], axis=1).ravel()
    ends = np.arange(0, 3001, 2)
    label = (marks[:, 0] ^ marks[:, 1]).astype(np.float32)
    value = np.ones(3000, np.float32)
    model = quality_fm._trained(ends, column, value, label, 4)
    out, _ = quality_fm._raw(*model, ends, column, value)
    assert ((out > 0) == (label > 0)).mean() > 0.99


def test_quality_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op12_quality_fm(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.95
    poor = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out and not r.quality]
    assert sum(p == 0 for p, _ in poor) >= 0.9 * len(poor)


def test_quality_odd_rows(spark, odd_docs):
    labelled = odd_docs.withColumn("weight", F.lit(float("nan"))).withColumn("label", F.lit("clash"))
    good = F.when(F.col("doc_id") % 2 == 0, 1).when(F.col("doc_id") == 3, F.lit(None)).otherwise(0)
    labels = odd_docs.select("doc_id", good.alias("good"), F.lit("clash").alias("text"))
    model = quality_fm.fit(labelled, labels, "good", metadata=("n_tokens", "weight"))
    assert quality_fm.fit(labelled, labels, "good", sample=4) is not None
    out = quality_fm.predict(labelled, model)
    assert out.count() == odd_docs.count() and sorted(out.columns) == sorted(labelled.columns)
    rows = out.collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1  # repeated rows score alike
    assert quality_fm.fit(labelled, labels.where("good is null"), "good") is None
    assert {r.score for r in quality_fm.predict(labelled, None).collect()} == {0.5}
    assert quality_fm.predict(labelled.limit(0), model).count() == 0


def test_quality_scores_do_not_depend_on_the_batch():
    texts = ["a b c", None, "", "x " * 400_000, "A | B | C", "so, it goes. on!"]
    one = [quality_fm.features(pa.array([t], pa.string())) for t in texts]
    all_ = quality_fm.features(pa.array(texts, pa.string()))
    for i, f in enumerate(one):
        lo, hi = all_.ends[i], all_.ends[i + 1]
        assert f.bucket.tolist() == all_.bucket[lo:hi].tolist() and np.allclose(f.value, all_.value[lo:hi])
        assert np.allclose(f.statistics[0], all_.statistics[i])


# -- periodic runs ----------------------------------------------------------


def _brute(words, least=24, times=3):
    out = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


@st.composite
def _word_lists(draw):
    words = []
    for _ in range(draw(st.integers(0, 6))):
        if words and draw(st.booleans()):
            p = draw(st.integers(1, min(len(words), 90)))
            for _ in range(draw(st.integers(1, 4 * p))):
                words.append(words[-p])
        else:
            words += draw(st.lists(st.integers(0, draw(st.sampled_from([1, 2, 40]))), min_size=1, max_size=30))
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(_word_lists(), min_size=1, max_size=4), st.sampled_from([3, 8, 24]))
def test_runs_equal_brute_force(texts, least):
    first = np.cumsum([0, *map(len, texts)])
    got = periodic_runs.runs(np.array(sum(texts, []), np.int32), first, least)
    assert [tuple(map(int, r)) for r in got] == [(i, *r) for i, t in enumerate(texts) for r in _brute(t, least)]


def test_runs_of_words_without_order():
    """Fibonacci and Thue-Morse words, whose powers are many and whose sums of bytes are alike."""
    fib, prev = [0, 1], [0]
    while len(fib) < 1500:
        fib, prev = fib + prev, fib
    morse = [bin(i).count("1") % 2 for i in range(1024)]
    for words in (fib[:1500], morse, morse * 3, fib[:300] * 4):
        got = periodic_runs.runs(np.array(words, np.int32), np.array([0, len(words)]), 3)
        assert [tuple(map(int, r[1:])) for r in got] == _brute(words, 3)


def test_a_long_run_takes_linear_work():
    """A million words with period 12 beside as many without one."""
    import time

    words = np.concatenate([np.arange(12).repeat(1)[np.arange(1_000_000) % 12], np.random.default_rng(0).integers(0, 1 << 30, 1_000_000)]).astype(np.int32)
    t = time.time()
    got = periodic_runs.runs(words, np.array([0, len(words)]), 24)
    assert [tuple(map(int, r)) for r in got] == [(0, 0, 1_000_000, 12)]
    assert time.time() - t < 60


def test_runs_of_whole_texts(spark, odd_docs):
    rows = [(1, "a b " * 20), (2, " x  " * 30 + "end"), (3, "nospace" * 200_000), (44, ("some words " * 5 + "q ") * 20_000), (None, "z\x1cz " * 30)]
    more = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("key", F.lit(1))
    for docs in (odd_docs, more):
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append((r.text or "").encode())
        got = defaultdict(list)
        for r in periodic_runs.find_runs(docs).collect():
            got[r.doc_id].append(r)
        assert set(got) == set(texts)
        for d, all_of in texts.items():
            want = []
            for text in all_of:
                words = text.split()
                runs = [(0, len(words), 11)] if d == 44 else _brute(words)
                dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
                want.append((len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()))
            assert sorted((r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got[d]) == sorted(want)
    assert periodic_runs.find_runs(odd_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(3, np.int32), np.array([0, 3]), 3, times=2)


def test_runs_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = 0
    for r in queries.op13_synchronised_runs(spark, SF).collect():
        words = (docs[r.doc_id] or "").encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = _brute(words) if n <= 4000 else None
        if runs is None:
            continue
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None, None, None)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest()
        seen += len(runs) > 0
    assert seen > 5
