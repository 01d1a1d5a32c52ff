"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

The index is two tables. ``shards`` has a row for each shard: the keys of its
documents in ascending order (a document's place there is its local number)
and their lengths in terms. ``postings`` has a row for each shard and term:
its documents in blocks of 128, packed byte-aligned (differences to the block's
first document, and frequencies), and for each block the skyline of its
(frequency, length) pairs, which no other pair of the block beats in both. No
statistic of the whole corpus is in the index, so shards can be added; document
frequencies are sums over the shards' rows.

A search takes the postings of the queries' terms only, and all shards. In a
shard each term has a bound, its largest possible contribution, and each block
one, from its skyline. A query's terms are ordered by bound; those whose bounds
together stay below the k-th score found so far are non-essential: documents
that have only such terms can't enter. So candidates come from the essential
lists alone, some documents at a time. They meet the other lists from the
largest bound down, and each list is looked at only for candidates that could
still enter with its *block's* bound; blocks without such a candidate are never
unpacked. Each shard keeps its k best, and the shards' lists are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from routecast.llm import store

#: Documents of a posting block.
BLOCK = 128
#: A shard is closed at so many words or documents; a longer document has a shard of its own.
SHARD_WORDS, SHARD_DOCS = 4 << 20, 1 << 16
#: Words of texts that are counted at once.
COUNTED = 1 << 17
#: Terms of a written batch, and the columns of the index.
TERMS = 1 << 14
COLUMNS = ("shard", "n_docs", "n_terms", "sizes", "term", "df", "blocks", "skyline", "postings", "keys")
#: Distinct terms of queries that are searched together, about.
QUERY_TERMS = 50_000
#: Documents whose scores are summed at once: few at first, so that there soon is a k-th score, then up to the second number.
SPANS = 1 << 8, 1 << 13
#: Fixed values of the score: saturation 1.2 and length weight 25 %, as whole numbers.
GAIN, STEEP, PLAIN, BY_LENGTH = 1_000_000_000, 12, 75, 25

#: A-Z become lower case; all other ASCII but letters and digits separates terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Bytes of a text that is split at once.
_PIECE = 1 << 19


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _PIECE)
        while end < len(text) and _TERMS[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_TERMS).split()
        at = end


class _Counter:
    """(term, document, frequency) of the documents of one shard, counted in parts of bounded size."""

    def __init__(self):
        self.keys: list[pa.Array] = []
        self.sizes: list[int] = []
        self.codes: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: list[bytes] = []
        self.owners: list[tuple[int, int]] = []

    def add(self, key: pa.Array, text: bytes) -> None:
        doc, n = len(self.sizes), 0
        for words in _terms(text):
            n += len(words)
            self.words += words
            self.owners.append((doc, len(words)))
            if len(self.words) >= COUNTED:
                self.count()
        self.keys.append(key)
        self.sizes.append(n)

    def count(self) -> None:
        if not self.words:
            return
        coded = pa.array(self.words, pa.binary()).dictionary_encode()
        codes = self.codes
        own = np.array([codes.setdefault(t, len(codes)) for t in coded.dictionary.to_pylist()], np.int64)
        docs = np.repeat(*np.array(self.owners, np.int64).T)
        pair, n = np.unique(own[coded.indices.to_numpy()] << 32 | docs, return_counts=True)
        self.parts.append((pair, n))
        self.words, self.owners = [], []

    def batches(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The shard's row, then the rows of its terms."""
        self.count()
        keys = pa.concat_arrays(self.keys)
        order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
        local = np.empty(len(order), np.int64)
        local[order] = np.arange(len(order))
        size = np.array(self.sizes, np.int64)[order]
        sorted_keys = keys.take(pa.array(order))
        yield _batch(
            keys.type,
            shard=pa.array([shard]),
            n_docs=pa.array([int((size > 0).sum())]),
            n_terms=pa.array([int(size.sum())]),
            sizes=pa.array([size.astype("<i8").tobytes()]),
            keys=pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), sorted_keys),
        )
        if self.parts:
            yield from self._terms(shard, local, size)

    def _terms(self, shard: int, local: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        pair = np.concatenate([p for p, _ in self.parts])
        tf = np.concatenate([n for _, n in self.parts])
        pair = (pair >> 32 << 32) | local[pair & 0xFFFFFFFF]
        by = np.argsort(pair)
        pair, tf = pair[by], tf[by]
        # A document that was counted in parts has one entry a part.
        head = np.flatnonzero(np.diff(pair, prepend=-1))
        tf = np.add.reduceat(tf, head)
        term, doc = pair[head] >> 32, pair[head] & 0xFFFFFFFF
        start = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(start, append=len(term))
        # Blocks: every 128 postings of a term.
        rank = np.arange(len(term)) - np.repeat(start, df)
        block_start = np.flatnonzero(rank % BLOCK == 0)
        block_size = np.diff(block_start, append=len(term))
        block = np.repeat(np.arange(len(block_start)), block_size)
        base = doc[block_start]
        gap = doc - base[block]
        gap_width = _widths(np.maximum.reduceat(gap, block_start))
        tf_width = _widths(np.maximum.reduceat(tf, block_start))
        data, bounds = _packed(gap, tf, block, block_size, gap_width, tf_width)
        s_block, s_tf, s_size = _skyline(block, tf, size[doc])
        s_ends = np.searchsorted(s_block, np.arange(len(block_start) + 1))
        heads = np.stack([base, doc[block_start + block_size - 1], gap_width, tf_width, np.diff(s_ends)], axis=1).astype("<i4")
        sky = np.stack([s_tf, s_size], axis=1).astype("<i4")
        first = np.append(np.searchsorted(block_start, start), len(block_start))
        names = pa.array(list(self.codes), pa.binary())
        for lo in range(0, len(start), TERMS):
            at = first[lo : min(len(start), lo + TERMS) + 1]
            n = len(at) - 1
            yield _batch(
                self.keys[0].type,
                shard=pa.array(np.full(n, shard)),
                term=names.take(pa.array(term[start[lo : lo + n]])),
                df=pa.array(df[lo : lo + n]),
                blocks=_slices(heads, at),
                skyline=_slices(sky, s_ends[at]),
                postings=_slices(data[:, None], bounds[at]),
            )


def _slices(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of rows as binary values."""
    width = rows.shape[1] * rows.itemsize
    data = np.ascontiguousarray(rows[ends[0] : ends[-1]])
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(((ends - ends[0]) * width).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _batch(key_type: pa.DataType, **columns: pa.Array) -> pa.RecordBatch:
    n = len(columns["shard"])
    kinds = {c: pa.int64() for c in ("shard", "n_docs", "n_terms", "df")} | {c: pa.binary() for c in ("sizes", "term", "blocks", "skyline", "postings")} | {"keys": pa.list_(key_type)}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds[c])) for c in COLUMNS], names=list(COLUMNS))


def _widths(largest: np.ndarray) -> np.ndarray:
    """Bytes that hold a number: 1, 2 or 4."""
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def _packed(gap: np.ndarray, tf: np.ndarray, block: np.ndarray, size: np.ndarray, gap_width: np.ndarray, tf_width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All blocks one after the other (a block: its gaps, then its frequencies), and the bounds of each."""
    bounds = np.concatenate([[0], np.cumsum(size * (gap_width + tf_width))])
    data = np.zeros(int(bounds[-1]), np.uint8)
    rank = np.arange(len(block)) - np.repeat(np.cumsum(size) - size, size)
    for values, width, begin in ((gap, gap_width, bounds[:-1]), (tf, tf_width, bounds[:-1] + size * gap_width)):
        for w in (1, 2, 4):
            here = np.flatnonzero(width[block] == w)
            at = begin[block[here]] + rank[here] * w
            octets = values[here].astype(f"<u{w}").view(np.uint8).reshape(-1, w)
            for k in range(w):
                data[at + k] = octets[:, k]
    return data, bounds


def _skyline(block: np.ndarray, tf: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block the (frequency, length) pairs that no other pair beats: more frequent in a shorter document."""
    by = np.lexsort((size, -tf, block))
    block, tf, size = block[by], tf[by], size[by]
    # Smallest length so far in the block: a later block's keys all lie below those of earlier ones.
    height = int(size.max(initial=0)) + 1
    key = (block[-1] - block) * height + size
    so_far = np.minimum.accumulate(key)
    first = np.ones(len(key), bool)
    first[1:] = key[1:] < so_far[:-1]
    return block[first], tf[first], size[first]


class Index(NamedTuple):
    shards: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all rows' whole texts, written under the session's shared folder.

    Narrow: each task puts its rows into shards of at most ``SHARD_WORDS`` words
    and ``SHARD_DOCS`` documents, which bounds its memory; a longer text has a
    shard of its own and memory follows its length.

    A null or empty text is a document without terms, which no query finds.
    Null keys come last among equal scores; equal keys and repeated rows are
    documents of their own. No rows: an empty index. Other columns are left
    out, whatever their names.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    schema = StructType.fromDDL("shard long, n_docs long, n_terms long, sizes binary, term binary, df long, blocks binary, skyline binary, postings binary")
    schema = schema.add("keys", ArrayType(kind))
    numbered = rows.select("*", F.spark_partition_id().cast("long").alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, words, shard = _Counter(), 0, None

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            if shard is None:
                shard = batch.column(2)[0].as_py() << 32
            for i in range(batch.num_rows):
                t = texts[i].as_py() or b""
                about = len(t) // 4
                if counter.sizes and (words + about > SHARD_WORDS or len(counter.sizes) == SHARD_DOCS):
                    yield from counter.batches(shard)
                    counter, words, shard = _Counter(), 0, shard + 1
                counter.add(batch.column(0).slice(i, 1), t)
                words += about
        if counter.sizes:
            yield from counter.batches(shard)

    table = store.written(numbered.mapInArrow(run, schema), "lexical-index")
    return Index(
        table.where("term is null").select("shard", "keys", "sizes", "n_docs", "n_terms"),
        table.where("term is not null").select("shard", "term", "df", "blocks", "skyline", "postings"),
    )


class _List:
    """One term's postings in a shard; its blocks are unpacked when they are first asked for."""

    def __init__(self, df: int, blocks: bytes, skyline: bytes, postings: bytes, penalty: np.ndarray):
        self.penalty = penalty
        self.base, self.last, self.gap_width, self.tf_width, tops = np.frombuffer(blocks, "<i4").reshape(-1, 5).T.astype(np.int64)
        tf, size = np.frombuffer(skyline, "<i4").reshape(-1, 2).T.astype(np.int64)
        self.tops = np.cumsum(tops) - tops
        self.skyline = tf, size
        self.n = np.minimum(BLOCK, df - BLOCK * np.arange(len(self.base)))
        self.at = np.concatenate([[0], np.cumsum(self.n * (self.gap_width + self.tf_width))])
        self.data = postings
        self.unpacked: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(self.base)
        self.bounds: np.ndarray | None = None

    def block_bounds(self, of_size) -> np.ndarray:
        """The largest gain in each block."""
        if self.bounds is None:
            tf, size = self.skyline
            self.bounds = np.maximum.reduceat(gain(tf, of_size(size)), self.tops)
        return self.bounds

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and gains of block i."""
        if self.unpacked[i] is None:
            n, g, t, at = int(self.n[i]), int(self.gap_width[i]), int(self.tf_width[i]), int(self.at[i])
            doc = np.frombuffer(self.data, f"<u{g}", n, at) + self.base[i]
            tf = np.frombuffer(self.data, f"<u{t}", n, at + n * g).astype(np.int64)
            self.unpacked[i] = doc, gain(tf, self.penalty[doc])
        return self.unpacked[i]

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents lo..hi-1 that have the term, and their gains."""
        a, b = np.searchsorted(self.last, lo), np.searchsorted(self.base, hi)
        if a >= b:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        got = [self.block(i) for i in range(a, b)]
        doc, value = (got[0] if len(got) == 1 else tuple(map(np.concatenate, zip(*got))))
        x, y = np.searchsorted(doc, (lo, hi))
        return doc[x:y], value[x:y]


def gain(tf: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """What one occurrence of weight 1 in a query adds; the penalty is that of the document's length."""
    return GAIN * tf // (1000 * tf + STEEP * penalty)


def length_penalty(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return PLAIN + BY_LENGTH * n * n_docs // max(1, n_terms)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def best_in_shard(lists: list[tuple[_List, int]], of_size, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Local numbers and scores of the k best documents of a shard, best first: Block-Max MaxScore.

    ``lists``: each query term's postings with its weight (times its occurrences in the query), above 0."""
    lists = sorted(((p.block_bounds(of_size).max() * w, i, p, w) for i, (p, w) in enumerate(lists)), key=lambda x: x[:2])
    below = np.cumsum([0, *[x[0] for x in lists]])  # what the first i lists can add together
    top_doc, top_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    floor = 1  # the k-th score so far; documents come in ascending order, so an equal score comes too late
    hi, span = 0, SPANS[0]
    while hi < n_docs:
        lo, hi, span = hi, min(n_docs, hi + span), min(2 * span, SPANS[1])
        apart = int(np.searchsorted(below, floor)) - 1  # so many first lists can't reach the floor together
        if apart == len(lists):
            break
        total = np.zeros(hi - lo, np.int64)
        for _, _, p, w in lists[apart:]:
            doc, value = p.between(lo, hi)
            total[doc - lo] += w * value
        alive = np.flatnonzero(total)
        score = total[alive]
        for i in range(apart - 1, -1, -1):
            _, _, p, w = lists[i]
            # First by the bounds of all lists left, then with this list's own block in place of its bound.
            stay = score + below[i + 1] >= floor
            alive, score = alive[stay], score[stay]
            if not len(alive):
                break
            block = np.searchsorted(p.last, alive + lo)
            inside = block < len(p.last)
            bound = np.zeros(len(alive), np.int64)
            bound[inside] = w * p.block_bounds(of_size)[block[inside]] * (p.base[block[inside]] <= alive[inside] + lo)
            stay = score + bound + below[i] >= floor
            alive, score, block, bound = alive[stay], score[stay], block[stay], bound[stay]
            for b in np.unique(block[bound > 0]):
                doc, value = p.block(int(b))
                here = np.flatnonzero(block == b)
                at = np.minimum(np.searchsorted(doc, alive[here] + lo), len(doc) - 1)
                hit = doc[at] == alive[here] + lo
                score[here[hit]] += w * value[at[hit]]
        enter = score >= floor
        top_doc, top_score = np.concatenate([top_doc, alive[enter] + lo]), np.concatenate([top_score, score[enter]])
        if len(top_doc) >= k:
            best = np.lexsort((top_doc, -top_score))[:k]
            top_doc, top_score = top_doc[best], top_score[best]
            floor = int(top_score[-1]) + 1
    best = np.lexsort((top_doc, -top_score))[:k]
    return top_doc[best], top_score[best]


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``query`` (a number of its own for each row), ``key``, ``term`` and ``times``, of the whole texts."""
    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                for words in _terms(t):
                    counts = pa.array(words, pa.binary()).value_counts()
                    at = pa.array(np.full(len(counts), i))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), counts.field("values"), counts.field("counts")], names=["query", "key", "term", "times"])

    found = rows.mapInArrow(run, StructType([*rows.select("query", "key").schema, *StructType.fromDDL("term binary, times long")]))
    return found.groupBy("query", "key", "term").agg(F.sum("times").alias("times"))


def search(index: Index, queries: DataFrame, k: int = 20, key: str = "item_id", text: str = "text", found: str = "doc_id") -> DataFrame:
    """The k best documents of every query row: ``key``, ``rank``, ``found`` (the document's key), ``score``.

    Only documents with a score above 0 are found; equal scores are ranked by
    ascending document key. A query's repeated terms count as often as they occur.

    Queries are dealt into blocks of about ``QUERY_TERMS`` terms by a hash; each
    shard meets each block that has a term in common with it, as one group of
    bounded size. Nothing is broadcast or collected but the corpus totals.

    A null or empty query text finds nothing. Null and equal query keys: each
    row is a query of its own with ranks of its own. Columns other than those
    named are left out.
    """
    spark = queries.sparkSession
    store.small_batches(spark)
    n_docs, n_terms = (int(x or 0) for x in index.shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    asked = store.written(query_terms(queries, key, text), "query-terms")
    n_blocks = max(1, -(-asked.count() // QUERY_TERMS))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(n_blocks)))
    hits = store.written(index.postings.join(asked.select("part", "term").distinct(), "term"), "query-postings")
    df = hits.groupBy("part", "term").agg(F.sum("df").alias("df"))
    packed = asked.join(df, ["part", "term"]).groupBy("part").agg(F.collect_list(F.struct("query", "term", "times", "df")).alias("asked"))
    meet = hits.select("part", "shard").distinct()
    groups = (
        hits.withColumnRenamed("df", "n")
        .unionByName(meet.join(index.shards, "shard").select("part", "shard", "keys", "sizes"), allowMissingColumns=True)
        .unionByName(meet.join(packed, "part").select("part", "shard", "asked"), allowMissingColumns=True)
    )

    def run(table: pa.Table) -> pa.Table:
        return _searched(table, n_docs, n_terms, k)

    got = groups.groupBy("part", "shard").applyInArrow(run, StructType.fromDDL("query long, score long").add("found", index.shards.schema["keys"].dataType.elementType))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("found").asc_nulls_last())
    ranked = got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.select("query", "key").distinct()
    return ranked.join(names, "query").select(F.col("key").alias(key), "rank", F.col("found").alias(found), "score")


def _searched(table: pa.Table, n_docs: int, n_terms: int, k: int) -> pa.Table:
    """One shard's best documents for each query of one block."""
    is_shard = table.filter(pc.is_valid(table.column("sizes")))
    is_asked = table.filter(pc.is_valid(table.column("asked")))
    is_term = table.filter(pc.is_valid(table.column("term")))
    keys = is_shard.column("keys").combine_chunks().flatten()
    size = np.frombuffer(is_shard.column("sizes")[0].as_py(), "<i8")
    of_size = lambda n: length_penalty(n, n_docs, n_terms)
    penalty = of_size(size)
    lists = {
        t: _List(df, b, s, p, penalty)
        for t, df, b, s, p in zip(*(is_term.column(c).to_pylist() for c in ("term", "n", "blocks", "skyline", "postings")))
    }
    wanted: dict[int, list[tuple[_List, int]]] = {}
    rows = is_asked.column("asked").combine_chunks().flatten()
    for q, t, times, df in zip(*(rows.field(c).to_pylist() for c in ("query", "term", "times", "df"))):
        w = weight(df, n_docs) * times
        if t in lists and w > 0:
            wanted.setdefault(q, []).append((lists[t], w))
    query, score, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q, terms in wanted.items():
        doc, s = best_in_shard(terms, of_size, len(size), k)
        query.append(np.full(len(doc), q))
        score.append(s)
        place.append(doc)
    return pa.table({"query": np.concatenate(query), "score": np.concatenate(score), "found": keys.take(pa.array(np.concatenate(place)))})
