"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A text's features are sparse: its words, hashed to ``1 << BITS`` buckets and
scaled to one unit vector; the band of each structure statistic (how its
characters, words, sentences and lines are made); the band of each metadata
column. The model is linear in the features plus, for every pair of them, the
inner product of two low-rank factors. All pairs together cost no more than
the features: the sum over pairs is half of the squared sum less the sum of
squares, for each factor.

Executors turn whole texts into features. A bounded sample of labelled rows
trains the model in the driver (AdaGrad on the logistic loss), and a narrow
pass scores all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.llm import store, textscan

#: Words are hashed to 1 << BITS buckets.
BITS = 13
#: Bound of the training sample in rows: at most 200 MB of features in the driver, some 5 MB for usual texts.
SAMPLE = 4000
#: Factors of a feature, steps of the training (at least so many, in whole passes), rows of a step, step size, decay of linear weights and of factors.
FACTORS, STEPS, STEP_ROWS, RATE, DECAY, FACTOR_DECAY = 8, 640, 64, 0.08, 1e-5, 1e-4
#: Bands of a structure statistic; their edges are quantiles of the sample.
BANDS = 12
#: Characters counted at once.
COUNTED = 1 << 22

_WORD = textscan.word_bytes(" \t\n\v\f\r")
#: Kinds of bytes that structure statistics count.
_KINDS = ("other", "upper", "lower", "digit", "space", "line", "stop", "bar", "mark")
_KIND = np.zeros(256, np.uint8)
for _i, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\v\f\r", "\n", ".!?;:,", "|<>{}[]=_/\\#*~^", "\"'()$%&+-@`"), 1):
    _KIND[[ord(c) for c in _chars]] = _i
STATISTICS = ("bytes", "words", "word length", "upper", "digit", "stop", "bar", "mark", "other", "line", "distinct words", "most frequent word", "word repeated at once", "words in a line", "words to a stop", "shouted stops")


def _kinds(texts: pa.Array) -> np.ndarray:
    """How many bytes of each kind a text has: a row each."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = np.zeros((len(texts), len(_KINDS) + 1), np.float64)
    for lo in range(int(offsets[0]), int(offsets[-1]), COUNTED):
        hi = min(lo + COUNTED, int(offsets[-1]))
        row = np.searchsorted(offsets, np.arange(lo, hi), side="right") - 1
        kind = _KIND[data[lo:hi]].astype(np.int64)
        out += np.bincount(row * out.shape[1] + kind, minlength=out.size).reshape(out.shape)
        shout = np.flatnonzero(data[lo:hi] == 33)
        out[:, -1] += np.bincount(row[shout], minlength=len(texts))
    return out


class Features(NamedTuple):
    """Rows' features: ``ends`` cuts buckets and values into rows; ``statistics`` has a column each."""

    ends: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def features(texts: pa.Array) -> Features:
    """Word buckets and structure statistics of whole texts."""
    kinds = _kinds(texts)
    n_words, distinct, top, again = (np.zeros(len(texts)) for _ in range(4))
    ends, buckets, values = [0], [], []
    for w in textscan.words(texts, _WORD):
        rows = w.hi - w.lo
        here = slice(w.lo, w.hi)
        n_words[here] = np.bincount(w.row, minlength=rows)
        again[here] = np.bincount(w.row[1:][(w.number[1:] == w.number[:-1]) & (w.row[1:] == w.row[:-1])], minlength=rows)
        # Distinct words of each row, then distinct buckets.
        by = np.lexsort((w.number, w.row))
        row, number = w.row[by], w.number[by]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
        first = np.flatnonzero(new)
        times = np.diff(first, append=len(row))
        distinct[here] = np.bincount(row[first], minlength=rows)
        np.maximum.at(top[here], row[first], times)
        code, part = np.unique(row[first] << BITS | (number[first] >> np.uint64(64 - BITS)).astype(np.int64), return_inverse=True)
        weight = np.bincount(part, weights=1 + np.log(times), minlength=len(code))
        of = code >> BITS
        norm = np.sqrt(np.bincount(of, weights=weight**2, minlength=rows))
        buckets.append(code & ((1 << BITS) - 1))
        values.append(weight / norm[of])
        ends += (ends[-1] + np.searchsorted(of, np.arange(1, rows + 1))).tolist()
    size = kinds[:, :-1].sum(axis=1)
    share = kinds / np.maximum(size, 1)[:, None]
    k = {name: share[:, i] for i, name in enumerate(_KINDS)}
    words = np.maximum(n_words, 1)
    stats = np.stack(
        [
            np.log1p(size), np.log1p(n_words), size / words, k["upper"], k["digit"], k["stop"], k["bar"], k["mark"], k["other"], k["line"],
            distinct / words, top / words, again / words, n_words / (kinds[:, 5] + 1), n_words / (kinds[:, 6] + 1), kinds[:, -1] / words,
        ],
        axis=1,
    )
    none = np.zeros(0)
    return Features(np.array(ends, np.int64), np.concatenate([none.astype(np.int64), *buckets]), np.concatenate([none, *values]), stats)


class Model(NamedTuple):
    edges: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    bias: float
    metadata: tuple[str, ...]


def _metadata_band(values: np.ndarray) -> np.ndarray:
    """0 for null and unusable values, else 1 to 63: the sign and the power of two of the value."""
    x = np.nan_to_num(values.astype(np.float64), nan=np.nan, posinf=np.nan, neginf=np.nan)
    power = np.clip(np.log2(1 + np.abs(np.where(np.isnan(x), 0, x))), 0, 30).astype(np.int64)
    return np.where(np.isnan(x), 0, np.where(x < 0, 33 + power, 1 + power))


def _entries(got: Features, bands: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of each row as (ends, column, value): words, then bands of statistics and of metadata."""
    n = len(got.ends) - 1
    fixed = got.statistics.shape[1] + bands.shape[1]
    of_stats = np.stack([np.searchsorted(edges[i], got.statistics[:, i], side="right") + i * BANDS for i in range(len(edges))], axis=1) + (1 << BITS)
    of_bands = bands + np.arange(bands.shape[1]) * 64 + (1 << BITS) + len(edges) * BANDS
    own = np.diff(got.ends)
    ends = np.concatenate([[0], np.cumsum(own + fixed)])
    column, value = np.empty(int(ends[-1]), np.int64), np.empty(int(ends[-1]), np.float32)
    row = np.repeat(np.arange(n), own)
    at = np.arange(len(row)) + row * fixed
    column[at], value[at] = got.bucket, got.value
    at = (ends[1:, None] - fixed + np.arange(fixed)).ravel()
    column[at] = np.concatenate([of_stats, of_bands], axis=1).ravel()
    value[at] = 1 / np.sqrt(fixed)
    return ends, column, value


def _raw(linear: np.ndarray, factors: np.ndarray, bias: float, ends: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output for each row (every row has features), and the factors' sums."""
    scaled = factors[column] * value[:, None]
    sums = np.add.reduceat(scaled, ends[:-1])
    squares = np.add.reduceat((scaled**2).sum(axis=1), ends[:-1])
    return bias + np.add.reduceat(linear[column] * value, ends[:-1]) + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def _trained(ends: np.ndarray, column: np.ndarray, value: np.ndarray, label: np.ndarray, width: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    random = np.random.default_rng(seed)
    linear, factors = np.zeros(width, np.float32), random.normal(0, 0.05, (width, FACTORS)).astype(np.float32)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    seen_linear, seen_factors, seen_bias = np.full(width, 1e-6, np.float32), np.full((width, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(-(-STEPS * STEP_ROWS // len(label))):
        order = random.permutation(len(label))
        for lo in range(0, len(order), STEP_ROWS):
            rows = order[lo : lo + STEP_ROWS]
            n = ends[rows + 1] - ends[rows]
            part = np.concatenate([[0], np.cumsum(n)])
            at = np.arange(part[-1]) + np.repeat(ends[rows] - part[:-1], n)
            col, val = column[at], value[at]
            out, sums = _raw(linear, factors, bias, part, col, val)
            error = (1 / (1 + np.exp(-out)) - label[rows]).astype(np.float32) / len(rows)
            e = np.repeat(error, n)
            used, where = np.unique(col, return_inverse=True)
            by = np.argsort(where, kind="stable")
            first = np.searchsorted(where[by], np.arange(len(used)))
            g_linear = np.add.reduceat((e * val)[by], first) + DECAY * linear[used]
            own = (e * val)[:, None] * (np.repeat(sums, n, axis=0) - factors[col] * val[:, None])
            g_factors = np.add.reduceat(own[by], first, axis=0) + FACTOR_DECAY * factors[used]
            seen_linear[used] += g_linear**2
            seen_factors[used] += g_factors**2
            seen_bias += float(error.sum()) ** 2
            linear[used] -= RATE * g_linear / np.sqrt(seen_linear[used])
            factors[used] -= RATE * g_factors / np.sqrt(seen_factors[used])
            bias -= RATE * float(error.sum()) / seen_bias**0.5
    return linear, factors, bias


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", metadata: Sequence[str] = (), sample: int = SAMPLE) -> Model | None:
    """A model from the rows of ``docs`` whose key has a label (above 0 counts as 1); None if there are none.

    At most ``sample`` labels are used, those with the smallest hashes of the
    key, so the sample is reproducible and grows with no table. These few rows
    are chosen first and broadcast; texts of other documents go nowhere. Whole
    texts become features on the executors. ``metadata``: numeric columns of
    ``docs`` that are features too. Null labels and keys take no part; null
    texts count as empty ones. Keys that repeat in ``docs`` or ``labels`` give
    several rows, of which ``sample`` are used.
    """
    store.small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("labelled"), (F.col(label) > 0).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(sample)
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        F.array(*[F.col(c).cast("double") for c in metadata]).cast("array<double>").alias("metadata"),
    )
    # The broadcast side has at most `sample` rows of a key and a label.
    chosen = rows.join(F.broadcast(known), F.col("key") == F.col("labelled")).select("label", "text", "metadata")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([f.bucket[a:b].astype("<u2").tobytes() for a, b in zip(f.ends, f.ends[1:])]),
                    pa.array([f.value[a:b].astype("<f4").tobytes() for a, b in zip(f.ends, f.ends[1:])]),
                    pa.array([x.astype("<f8").tobytes() for x in f.statistics]),
                ],
                names=["label", "metadata", "bucket", "value", "statistics"],
            )

    made = chosen.mapInArrow(run, "label int, metadata array<double>, bucket binary, value binary, statistics binary")
    # Only repeated keys can give more rows than the sample has.
    got = made.orderBy(F.xxhash64("bucket", "value", "label"), "statistics").limit(sample).collect()
    if not got:
        return None
    got.sort(key=lambda r: (r.label, bytes(r.bucket), bytes(r.value), bytes(r.statistics)))
    bucket = [np.frombuffer(bytes(r.bucket), "<u2") for r in got]
    ends = np.concatenate([[0], np.cumsum([len(b) for b in bucket])])
    stats = np.stack([np.frombuffer(bytes(r.statistics), "<f8") for r in got])
    found = Features(ends, np.concatenate(bucket).astype(np.int64), np.concatenate([np.frombuffer(bytes(r.value), "<f4") for r in got]), stats)
    edges = np.quantile(stats, np.linspace(0, 1, BANDS + 1)[1:-1], axis=0).T
    bands = np.array([[np.nan if x is None else x for x in r.metadata] for r in got], np.float64).reshape(len(got), len(metadata))
    label_of = np.array([r.label for r in got], np.float32)
    entries = _entries(found, _metadata_band(bands), edges)
    width = (1 << BITS) + len(edges) * BANDS + 64 * len(metadata)
    return Model(edges, *_trained(*entries, label_of, width), tuple(metadata))


def scores(model: Model, texts: pa.Array, metadata: np.ndarray) -> np.ndarray:
    entries = _entries(features(texts), _metadata_band(metadata), model.edges)
    out, _ = _raw(model.linear, model.factors, model.bias, *entries)
    return 1 / (1 + np.exp(-np.clip(out.astype(np.float64), -500, 500)))


def predict(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the column ``score`` (0 to 1; higher: label 1 likelier), from the whole text and the model's metadata columns.

    Narrow: one pass, no shuffle, half a megabyte of text at a time. Null and
    empty texts are scored as texts without words. Null, non-finite and missing
    metadata have a band of their own. Without a model all scores are 0.5. A
    column named like the score is replaced; all others and every row stay.
    """
    kept = [c for c in docs.columns if c != score]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    store.small_batches(docs.sparkSession)
    wanted = model.metadata if model else ()
    inputs = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).cast("string").alias("text"), F.array(*[F.col(c).cast("double") for c in wanted]).cast("array<double>").alias("metadata"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sent.value is None or not batch.num_rows:
                got = np.full(batch.num_rows, 0.5)
            else:
                meta = batch.column(2).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(wanted))
                sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy())
                parts, lo = [], 0
                while lo < batch.num_rows:
                    hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + textscan.SEGMENT, side="right")))
                    parts.append(scores(sent.value, batch.column(1).slice(lo, hi - lo), meta[lo:hi]))
                    lo = hi
                got = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], names=["doc", "score"])

    schema = inputs.select("doc").schema.add("score", "double")
    return inputs.mapInArrow(run, schema).select("doc.*", F.col("score").alias(score))
