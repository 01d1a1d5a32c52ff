"""Periodic runs of words in whole texts, by string synchronising sets.

A run is a stretch of words with smallest period q that is at least ``times``
periods long and that no neighbouring word extends. Periods are looked for at
dyadic scales t = 8, 16, 32 ...: a scale finds the periods from 1.5 t to 3 t.

At a scale a place is *selected* if, among the pieces of t words that start at
it and at the t places after it, the piece with the smallest hash is the first
or the last one. That depends on the 2 t words after the place alone, so equal
contexts are selected alike: in a run, what is selected in one period is
selected in the next. Two selected places with the same 2 t words propose
their distance as a period, and comparing words to both sides proves it.

Pieces with a period of t / 3 or less take no part in the selection (in them
nothing could tell one place from the next, and selected places would crowd).
They lie in runs that smaller scales have found; periods below those of the
first scale are read off directly, by comparing each word with the one q before.

A stretch of three periods always has a selected place in its first ones whose
context ends a period before the stretch does: if it had not, all of it would
have a period of t / 3, which contradicts q being its smallest. For the same
reason a context recurs at most nine times within 3 t words, so the work of a
scale is linear in the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from routecast.llm import store, textscan

#: Fixed value: bytes that separate words.
SEPARATORS = " \t\n\v\f\r"
#: The first scale; periods below 1.5 times it are read off directly.
SCALE = 8
#: Bytes of texts that are worked on together; a longer text by itself.
TOGETHER = 1 << 19
#: Words compared at once when stretches are followed.
COMPARED = 1 << 20

_WORD = textscan.word_bytes(SEPARATORS)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces of whole words."""
    if len(text) <= TOGETHER:
        yield text
        return
    at = 0
    while at < len(text):
        end = min(len(text), at + TOGETHER)
        while end < len(text) and _WORD[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts as numbers that are equal for equal words, and the place of each text's first word."""
    sizes, chunks = np.zeros(len(texts) + 1, np.int64), []
    words: list[bytes] = []
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            found = piece.split()
            sizes[i + 1] += len(found)
            words += found
            if len(words) > TOGETHER // 4:
                chunks.append(pa.array(words, pa.binary()).dictionary_encode())
                words = []
    chunks.append(pa.array(words, pa.binary()).dictionary_encode())
    joined = pa.chunked_array(chunks).unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in joined.chunks])
    return codes, np.cumsum(sizes)


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First place of, and place after, each stretch of at least ``least`` marks."""
    edge = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    first, after = edge[::2], edge[1::2]
    long = after - first >= least
    return first[long], after[long]


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by the place of the first of them; windows end with the array."""
    n = len(x)
    padded = np.full(-(-(n + width) // width) * width, _NONE)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _follow(codes: np.ndarray, at: np.ndarray, shift: np.ndarray, room: np.ndarray, step: int, chunk: int) -> np.ndarray:
    """How many words from ``at`` on (in direction ``step``) equal the ones ``shift`` later, up to ``room``."""
    got = np.zeros(len(at), np.int64)
    active = np.flatnonzero(room > 0)
    while len(active):
        still = []
        for part in np.array_split(active, max(1, -(-len(active) * chunk // COMPARED))):
            reach = np.arange(chunk)
            left = np.minimum(room[part] - got[part], chunk)
            place = at[part, None] + step * (got[part, None] + np.minimum(reach, left[:, None] - 1))
            differ = (codes[place] != codes[place + shift[part, None]]) | (reach >= left[:, None])
            stop = np.where(differ.any(axis=1), differ.argmax(axis=1), chunk)
            got[part] += stop
            still.append(part[(stop == chunk) & (got[part] < room[part])])
        active = np.concatenate(still)
        chunk = min(2 * chunk, 1 << 16)
    return got


def runs(codes: np.ndarray, first: np.ndarray, least: int, times: int = 3) -> np.ndarray:
    """Rows (text, start, length, period) of the runs of several texts, in that order.

    Text i has the words ``codes[first[i]:first[i + 1]]``. ``times`` is 3 or more."""
    if times < 3:
        raise ValueError("a run has at least three periods")
    found = []  # places in `codes`: first, after, period
    size = np.diff(first)
    end = np.repeat(first[1:], size)
    # Short stretches count too: larger scales leave out the pieces inside them.
    short = min(least, SCALE)
    for q in range(1, min(SCALE * 3 // 2, len(codes))):
        lo, hi = _stretches((codes[:-q] == codes[q:]) & (end[:-q] == end[q:]), max(times * q, short) - q)
        found.append(np.stack([lo, hi + q, np.full(len(lo), q)], axis=1))
    name = textscan.mixed(codes.astype(np.uint64) + np.uint64(1))
    place = np.arange(len(codes))
    width, t = 1, SCALE
    longest = int(size.max(initial=0))
    while 3 * (t * 3 // 2) <= longest:
        # Texts too short for this scale's periods leave.
        stay = np.repeat(size, size)[place] >= 3 * (t * 3 // 2)
        if not stay.all():
            place, name = place[stay], name[stay]
        while width < t:
            name, width = _doubled(name, width), 2 * width
        context = _doubled(name, t)
        room = end[place] - place
        barred = np.zeros(len(codes) + 1, np.int32)
        for lo, hi, q in (f.T for f in found):
            periodic = (3 * q <= t) & (hi - lo >= t)
            np.add.at(barred, lo[periodic], 1)
            np.add.at(barred, hi[periodic] - t + 1, -1)
        hidden = (np.cumsum(barred)[place] > 0) | (room < t)
        order = np.where(hidden, _NONE, name)
        least_near = _window_min(order, t + 1)
        later = np.full(len(order), _NONE)
        later[:-t] = order[t:]
        selected = np.flatnonzero((room >= 2 * t) & (least_near != _NONE) & ((least_near == order) | (least_near == later)))
        found.append(_proposed(codes, first, end, place[selected], context[selected], t, times))
        t *= 2
    return _shaped(np.concatenate(found), first, least) if found else np.zeros((0, 4), np.int64)


def _doubled(name: np.ndarray, width: int) -> np.ndarray:
    """Hashes of pieces of 2 * width words from those of width words; a piece that passes its text's end has any hash."""
    out = name * np.uint64(0x9E3779B97F4A7C15)
    out[:-width] += name[width:]
    return textscan.mixed(out ^ np.uint64(width))


def _proposed(codes: np.ndarray, first: np.ndarray, end: np.ndarray, place: np.ndarray, context: np.ndarray, t: int, times: int) -> np.ndarray:
    """Stretches whose period is the distance of two selected places with the same context."""
    by = np.argsort(context, kind="stable")
    place, context = place[by], context[by]
    starts, shifts = [], []
    at, ahead = np.arange(len(place)), 1
    while len(at):
        at = at[at + ahead < len(place)]
        d = place[at + ahead] - place[at]
        near = (context[at] == context[at + ahead]) & (d < 3 * t) & (end[place[at]] == end[place[at + ahead]])
        at, d = at[near], d[near]
        fits = 2 * d >= 3 * t
        starts.append(place[at[fits]])
        shifts.append(d[fits])
        ahead += 1
    start = np.concatenate([np.zeros(0, np.int64), *starts])
    shift = np.concatenate([np.zeros(0, np.int64), *shifts])
    # Equal contexts at one distance that overlap or touch belong to one stretch: its first place stands for them.
    by = np.lexsort((start, shift))
    start, shift = start[by], shift[by]
    head = np.ones(len(start), bool)
    head[1:] = (shift[1:] != shift[:-1]) | (start[1:] - start[:-1] > 2 * t)
    start, shift = start[head], shift[head]
    opening = first[np.searchsorted(first, start, side="right") - 1]
    after = start + _follow(codes, start, shift, end[start] - shift - start, 1, 2 * t) + shift
    begin = start - _follow(codes, start - 1, shift, start - opening, -1, t)
    real = after - begin >= times * shift
    return np.stack([begin, after, shift], axis=1)[real]


def _shaped(found: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    found = found[found[:, 1] - found[:, 0] >= least]
    # A stretch with period q has period 2 q too: the smallest stays.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    lo, hi, q = found[new].T
    text = np.searchsorted(first, lo, side="right") - 1
    out = np.stack([text, lo - first[text], hi - lo, q], axis=1)
    return out[np.lexsort((q, lo))]


def _collapsed(text: bytes, dropped: np.ndarray | None) -> bytes:
    kept, at = [], 0
    for piece in _pieces(text):
        words = piece.split()
        if dropped is not None:
            here = ~dropped[at : at + len(words)]
            at += len(words)
            words = compress(words, here.tolist())
        kept.append(b" ".join(words))
    return b" ".join(filter(None, kept))


def _found(texts: list[bytes], least: int, times: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    codes, first = _codes(texts)
    got = runs(codes, first, least, times)
    edge = np.zeros(len(codes) + 1, np.int32)
    lo = first[got[:, 0]] + got[:, 1]
    np.add.at(edge, lo + got[:, 3], 1)
    np.add.at(edge, lo + got[:, 2], -1)
    dropped = np.cumsum(edge)[:-1] > 0
    struct = pa.StructArray.from_arrays([pa.array(got[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
    ends = np.searchsorted(got[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
    collapsed = [_collapsed(t, dropped[first[i] : first[i + 1]] if ends[i + 1] > ends[i] else None) for i, t in enumerate(texts)]
    return np.diff(first), pa.ListArray.from_arrays(pa.array(ends), struct), pa.array(collapsed, pa.binary()).cast(pa.string())


def find_runs(docs: DataFrame, least: int = 24, times: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are (start, length, period) in words numbered from 0, by start,
    then period: every maximal stretch with smallest period ``period`` that is
    at least ``least`` words and ``times`` periods long. ``collapsed`` is the
    text without the words that any run holds after its first period, the kept
    words joined by one space.

    Narrow: one pass, no shuffle, whole texts. Memory follows the longest text
    (some 60 bytes a word), other texts are taken half a megabyte at a time.

    Words are runs of bytes other than ASCII white space. Null and empty texts
    have no words and no runs, and collapse to ''. Null keys, equal keys and
    repeated rows keep a row each. No rows give no rows. Other columns are left
    out, whatever their names.
    """
    store.small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            sizes = np.asarray(pc.binary_length(column).fill_null(0))
            total, lo = np.cumsum(sizes), 0
            while lo < batch.num_rows:
                before = total[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(total, before + TOGETHER, side="right")))
                n, found, collapsed = _found([t or b"" for t in column.slice(lo, hi - lo).to_pylist()], least, times)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), found, collapsed], names=["key", "n_words", "runs", "collapsed"])
                lo = hi

    schema = StructType([rows.schema["key"], *StructType.fromDDL("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")])
    out = rows.mapInArrow(run, schema)
    return out.withColumnRenamed("key", key)
