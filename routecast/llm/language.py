"""Language ID by string kernels: Nyström features and one-versus-rest kernel ridge regression.

The kernel of two texts counts the n-grams (of 1 to 3 bytes, together: the
blended spectrum) present in both, divided by the geometric mean of how many
each has. Presence, not frequency, makes it insensitive to length and to
repeated lines. A bounded sample of labelled texts trains it; landmarks drawn
from the sample span the Nyström feature space K(x, L) K(L, L)^(-1/2), in
which one ridge regression per language is solved. Since the model is linear
in the presence vector, a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routecast.llm import store

#: n-grams are numbered by a hash to this many bits.
BITS = 17
#: Bounds of the training sample: rows in all (but one for each language at least) and landmarks among them.
SAMPLE, LANDMARKS = 1600, 320
#: Languages whose counts are broadcast; more are joined.
BROADCAST_LANGUAGES = 10_000
#: Characters of a text that are looked at together.
SEGMENT = 1 << 18
RIDGE = 1e-2
#: Rows scored by one product.
BATCH = 128
UNDETERMINED = "und"

#: ASCII other than letters becomes a space, so n-grams see word edges but no digits or marks.
_CLEAN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


class Model(NamedTuple):
    """``weights``: matrices whose product takes the n-grams ``columns`` to the languages' scores."""

    languages: list[str]
    columns: np.ndarray
    weights: list[np.ndarray]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def present(text: str, table: np.ndarray) -> np.ndarray:
    """Marks the n-grams of the whole text in ``table`` (cleared first), a segment at a time."""
    table[:] = False
    before = b" "
    for lo in range(0, max(1, len(text)), SEGMENT):
        piece = text[lo : lo + SEGMENT].lower().encode("utf-8", "replace").translate(_CLEAN)
        if lo + SEGMENT >= len(text):
            piece += b" "
        b = np.frombuffer(before + piece, np.uint8).astype(np.uint32)
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for n, code in ((1, b), (2, two), (3, three)):
            table[((code + np.uint32(n << 24)) * np.uint32(2_654_435_761)) >> np.uint32(32 - BITS)] = True
        before = (before + piece)[-2:]
    return table


def _bit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << BITS, bool)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if has_letter(text):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.packbits(present(text, table)).tobytes()])], names=["lang", "bits"])


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", spread: str | None = None) -> Model | None:
    """A model from the rows whose language and text are not null; None if there are none.

    Bounds: at most ``SAMPLE`` rows are used, an equal share for each language,
    and one row of each where there are more languages than that. The sample is
    drawn by a hash of the text and of the column ``spread``, so it is
    reproducible and a text that is copied very often doesn't fill it. Whole
    texts are reduced to presence bits by the executors; only those (16 kB a
    row) are collected.
    """
    store.small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(*[c for c in (text, spread) if c]).alias("h"))
    rows = rows.where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count()
    n_languages = counts.count()
    if not n_languages:
        return None
    share = max(1, SAMPLE // n_languages)
    # Expected share * 2 rows of a language pass the hash, and the first of them stay.
    part = F.least(F.lit(1.0), F.lit(2.0 * (share + 10)) / F.col("count"))
    few = counts.select(F.col("lang").alias("of"), (F.lit(float(1 << 32)) * part).cast("long").alias("below"))
    if n_languages <= BROADCAST_LANGUAGES:
        few = F.broadcast(few)
    passes = F.pmod("h", F.lit(1 << 32)) < F.col("below")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = rows.join(few, F.col("lang") == F.col("of")).where(passes).withColumn("k", first).where(F.col("k") <= share).orderBy("h").select("lang", "text")
    got = sample.mapInArrow(_bit_rows, "lang string, bits binary").collect()
    if not got:
        return None
    names = sorted({r[0] for r in got})
    got.sort(key=lambda r: (r[0], bytes(r[1])))
    bits = np.array([np.frombuffer(bytes(r[1]), np.uint8) for r in got])
    which = np.array([names.index(r[0]) for r in got])
    # Landmarks: every so-many-th row of the sorted sample, so each language has its share.
    marks = np.unique(np.linspace(0, len(got) - 1, min(LANDMARKS, len(got))).astype(int))
    size = np.array([int(np.unpackbits(x).sum()) for x in bits], np.float64)
    columns = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits[marks], axis=0)))
    unpacked = lambda rows: np.unpackbits(rows, axis=1)[:, columns].astype(np.float32)
    of_marks = unpacked(bits[marks]) / np.sqrt(size[marks])[:, None].astype(np.float32)
    parts = [unpacked(bits[lo : lo + BATCH]) @ of_marks.T for lo in range(0, len(bits), BATCH)]
    kernel = np.concatenate(parts).astype(np.float64) / np.sqrt(size)[:, None]
    value, vector = np.linalg.eigh(kernel[marks])
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    features = kernel @ root
    target = np.where(which[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Languages weigh the same however many rows of the sample are theirs.
    weight = (1 / np.bincount(which, minlength=len(names)))[which][:, None] * len(which) / len(names)
    ridge = np.linalg.solve(features.T @ (weight * features) + RIDGE * np.eye(features.shape[1]), features.T @ (weight * target))
    scored = (root @ ridge).astype(np.float32)
    # Few languages: one matrix. Many: through the landmarks, so that no matrix has n-grams times languages.
    return Model(names, columns, [of_marks.T @ scored] if len(names) <= LANDMARKS else [of_marks.T, scored])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    ``text`` may name a field of a struct column (``doc.text``): whole rows then
    travel as that one column.

    Narrow: one pass, no shuffle. ``und`` with score 0 if the text is null or
    has no letter, or if there is no model. Among equal scores the first
    language by name wins. Columns named like the added ones are replaced; all
    others and every row stay.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    store.small_batches(docs.sparkSession)
    column, _, field = text.partition(".")
    at = kept.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = np.zeros(1 << BITS, bool)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                names, scores = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                if model is not None:
                    texts = part.column(at)
                    texts = (pc.struct_field(texts, field) if field else texts).to_pylist()
                    known = [i for i, t in enumerate(texts) if has_letter(t)]
                    x = np.zeros((len(known), len(model.columns)), np.float32)
                    for k, i in enumerate(known):
                        marked = present(texts[i], table)
                        x[k] = marked[model.columns]
                        x[k] /= np.sqrt(marked.sum())
                    got = reduce(np.matmul, model.weights, x)
                    for k, i in enumerate(known):
                        best = int(got[k].argmax())
                        names[i], scores[i] = model.languages[best], min(1.0, max(0.0, (float(got[k, best]) + 1) / 2))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*kept).mapInArrow(run, schema)


def held_out(key: str):
    """Whether a row is never learned from: crc32 of the key as text is divisible by 5; so is a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))
