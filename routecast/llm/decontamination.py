"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``window`` consecutive words of an item (an item of fewer words,
but not none, is one window). It occurs in a document only if all its shingles
do, so its prefix, the rarest shingle in the documents, must. The join looks
up the documents' shingles among the prefixes alone; a hit at a place fixes
where the window would start, and the length bound (the window fits into the
row there) precedes the exact comparison of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from routecast.llm import store, textscan

#: Fixed value: word separators, that is ASCII without digits and letters.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
WORD = textscan.word_bytes(SEPARATORS)
#: Words of a shingle.
SHINGLE = 3
#: UTF-8 bytes of items whose windows are built in the driver and broadcast:
#: some 700,000 words, or about 300 MB of windows while they are built. The
#: windows of more items are a table that the documents' shingles are joined with.
BLOCK_BYTES = 4 << 20
_BITS = 20
#: The filter of a table's shingles: 16 bits each, at most 2**27 bits (16 MB).
#: A fuller one lets more pass, which the joins then turn away.
FILTER_BITS = 27
#: Rows that Python emits at a time.
EMITTED = 1 << 16
#: Keys with more than this part of a join's rows are cut; there are fewer than this many.
HOT_PARTS = 1000


class _Windows:
    """The distinct windows of a block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        self.ids = sorted({i for i, _ in items})
        place = {i: k for k, i in enumerate(self.ids)}
        owner = [place[i] for i, _ in items]
        found: dict[bytes, tuple[np.ndarray, set[int]]] = {}
        for w in textscan.words(texts, WORD):
            b = w.bounds()
            for r in range(w.hi - w.lo):
                own = w.number[b[r] : b[r + 1]]
                for at in range(max(1, len(own) - window + 1) if len(own) else 0):
                    run = own[at : at + window]
                    found.setdefault(run.tobytes(), (run, set()))[1].add(owner[w.lo + r])
        by_size: dict[int, list[tuple[np.ndarray, set[int]]]] = {}
        for run, owners in found.values():
            by_size.setdefault(len(run), []).append((run, owners))
        #: For each window length: the words of its windows, a row each.
        self.words = {n: np.array([run for run, _ in v]) for n, v in by_size.items()}
        owners = {n: [sorted(o) for _, o in v] for n, v in by_size.items()}
        self.owner_ends = {n: np.cumsum([0, *map(len, v)]) for n, v in owners.items()}
        self.owners = {n: np.array([x for o in v for x in o], np.int64) for n, v in owners.items()}

    def shingled(self, n: int) -> np.ndarray:
        """The shingles of the windows of length n: a row each."""
        words, size = self.words[n], min(SHINGLE, n)
        flat, _ = textscan.shingles(words.ravel(), np.repeat(np.arange(len(words)), n), size)
        return flat.reshape(len(words), n - size + 1)


class _Lookup:
    """Numbers found among sorted ones, most others being turned away by a bit table."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.table = np.zeros(1 << _BITS, bool)
        self.table[(numbers >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``seen`` of known numbers, and which they are."""
        at = np.flatnonzero(self.table[(seen >> np.uint64(64 - _BITS)).astype(np.int64)])
        k = np.searchsorted(self.numbers, seen[at])
        k[k == len(self.numbers)] = 0
        same = self.numbers[k] == seen[at] if len(self.numbers) else np.zeros(0, bool)
        return at[same], k[same]


def _rarity(rows: DataFrame, known: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each known shingle (by size) occurs in all texts. At most one count per known shingle is collected."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {n: _Lookup(v) for n, v in sent.value.items()}
        counts = {n: np.zeros(len(v), np.int64) for n, v in sent.value.items()}
        for batch in batches:
            for w in textscan.words(batch.column(batch.num_columns - 1), WORD):
                for n, lookup in lookups.items():
                    _, k = lookup.find(textscan.shingles(w.number, w.row, n)[0])
                    counts[n] += np.bincount(k, minlength=len(counts[n]))
        for n, c in counts.items():
            k = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), n, np.int32)), pa.array(k), pa.array(c[k])], names=["size", "k", "n"])

    out = {n: np.zeros(len(v), np.int64) for n, v in known.items()}
    for size, k, n in rows.mapInArrow(run, "size int, k long, n long").groupBy("size", "k").agg(F.sum("n")).collect():
        out[size][k] = n
    return out


def _with_block(rows: DataFrame, items: list[tuple[str, str]], window: int, field: str) -> DataFrame:
    """For each row (row, key, text): n_words, the merged spans of hit words, the items found.

    ``field``: the field of the key that is the text, if there is no column of it."""
    index = _Windows(items, window)
    sizes = sorted({min(SHINGLE, n) for n in index.words})
    shingled = {n: index.shingled(n) for n in index.words}
    known = {s: np.unique(np.concatenate([shingled[n].ravel() for n in index.words if min(SHINGLE, n) == s])) for s in sizes}
    often = _rarity(rows.select(F.col(f"key.{field}") if field else "text"), known)
    # Prefix of each window: its rarest shingle, the smaller number among equals.
    prefixes = {}
    for s in sizes:
        parts = []
        for n in (n for n in index.words if min(SHINGLE, n) == s):
            k = np.searchsorted(known[s], shingled[n])
            rank = np.lexsort((known[s], often[s])).argsort()
            at = rank[k].argmin(axis=1)
            parts.append((known[s][k[np.arange(len(k)), at]], np.full(len(k), n), np.arange(len(k)), at))
        number, n, which, at = map(np.concatenate, zip(*parts))
        by = np.argsort(number, kind="stable")
        heads, first = np.unique(number[by], return_index=True)
        prefixes[s] = (heads, np.append(first, len(by)), n[by], which[by], at[by])
    sent = rows.sparkSession.sparkContext.broadcast((index, prefixes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, prefixes = sent.value
        lookups = {s: _Lookup(p[0]) for s, p in prefixes.items()}
        for batch in batches:
            text = batch.column(2) if not field else pc.struct_field(batch.column(1), field)
            for w in textscan.words(text, WORD):
                rows_here = w.hi - w.lo
                bounds = w.bounds()
                edge = np.zeros(len(w.number) + 1, np.int64)
                owned = []
                for s, (_, first, size, which, offset) in prefixes.items():
                    number, at = textscan.shingles(w.number, w.row, s)
                    seen, head = lookups[s].find(number)
                    many = first[head + 1] - first[head]
                    entry = np.repeat(first[head] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                    place = np.repeat(at[seen], many) - offset[entry]
                    r = w.row[np.repeat(at[seen], many)]
                    fits = (place >= bounds[r]) & (place + size[entry] <= bounds[r + 1])
                    for n in np.unique(size[entry[fits]]):
                        here = fits & (size[entry] == n)
                        p, k = place[here], which[entry[here]]
                        same = (w.number[p[:, None] + np.arange(n)] == index.words[n][k]).all(axis=1)
                        p, k = p[same], k[same]
                        np.add.at(edge, p, 1)
                        np.add.at(edge, p + n, -1)
                        pairs = np.unique(w.row[p] * len(index.words[n]) + k)
                        pr, pk = pairs // len(index.words[n]), pairs % len(index.words[n])
                        ends = index.owner_ends[n]
                        each = ends[pk + 1] - ends[pk]
                        o = index.owners[n][np.repeat(ends[pk] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]
                        owned.append(np.repeat(pr, each) * len(index.ids) + o)
                # Runs of hit words, cut where a row ends.
                hit = np.cumsum(edge)[:-1] > 0
                new = np.ones(len(hit), bool)
                new[1:] = ~hit[:-1] | (w.row[1:] != w.row[:-1])
                start = np.flatnonzero(hit & new)
                last = np.ones(len(hit), bool)
                last[:-1] = ~hit[1:] | (w.row[1:] != w.row[:-1])
                end = np.flatnonzero(hit & last) + 1
                row_of = w.row[start]
                span_ends = np.searchsorted(row_of, np.arange(rows_here + 1))
                spans = pa.StructArray.from_arrays([pa.array(start - bounds[row_of]), pa.array(end - bounds[row_of])], names=["first", "end"])
                owned_all = np.unique(np.concatenate(owned)) if owned else np.zeros(0, np.int64)
                item_row = owned_all // max(1, len(index.ids))
                names = pa.array(index.ids, pa.string()).take(pa.array(owned_all % max(1, len(index.ids))))
                item_ends = np.searchsorted(item_row, np.arange(rows_here + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.lo, rows_here),
                        batch.column(1).slice(w.lo, rows_here),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(span_ends.astype(np.int32)), spans),
                        pa.ListArray.from_arrays(pa.array(item_ends.astype(np.int32)), names),
                    ],
                    names=["row", "key", "n_words", "spans", "items"],
                )

    schema = rows.select("row", "key").schema.add("n_words", "long")
    found = StructType.fromDDL("spans array<struct<first:long,end:long>>, items array<string>")
    return rows.mapInArrow(run, StructType(schema.fields + found.fields))


def _item_windows(named: DataFrame, window: int) -> DataFrame:
    """(words, item): each window of each item, as its words' numbers; some repeats are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in textscan.words(batch.column(1), WORD):
                bounds = w.bounds()
                have = np.diff(bounds)
                many = np.where(have > 0, np.maximum(1, have - window + 1), 0)
                r = np.repeat(np.arange(len(have)), many)
                start = bounds[r] + np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many)
                length = np.minimum(window, have[r])
                for lo in range(0, len(r), EMITTED):
                    here = slice(lo, lo + EMITTED)
                    names = batch.column(0).take(pa.array(w.lo + r[here]))
                    yield pa.RecordBatch.from_arrays([_runs(w.number, start[here], start[here] + length[here]), names], names=["words", "item"])

    return named.select("id", "text").mapInArrow(run, "words binary, item string")


def _runs(number: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The numbers start..end - 1 of each run as bytes."""
    ends = np.append(0, np.cumsum(end - start))
    flat = number[np.repeat(start - ends[:-1], end - start) + np.arange(ends[-1])].astype("<u8")
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(flat)])


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(words, number, at): each shingle of each window, by number, and its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            length = pc.binary_length(words).to_numpy() // 8
            for n in np.unique(length):
                which = np.flatnonzero(length == n)
                chosen = words.take(pa.array(which))
                number = np.frombuffer(b"".join(chosen.to_pylist()), "<u8")
                size = min(SHINGLE, int(n))
                found, at = textscan.shingles(number, np.repeat(np.arange(len(which)), n), size)
                yield pa.RecordBatch.from_arrays(
                    [chosen.take(pa.array(at // n)), pa.array(found.view(np.int64)), pa.array((at % n).astype(np.int32))], names=["words", "number", "at"]
                )

    return windows.select("words").mapInArrow(run, "words binary, number long, at int")


class _Filter:
    """Turns away most numbers that a table doesn't have; its size is bounded by ``FILTER_BITS``."""

    def __init__(self, numbers: DataFrame):
        known = numbers.count()
        self.shift = 64 - min(FILTER_BITS, max(10, (16 * known).bit_length()))
        slot = F.shiftrightunsigned("number", self.shift)
        cells = numbers.groupBy(F.shiftright(slot, 6).alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(number, {self.shift}) & 63 as int))")).alias("bits")).toArrow()
        table = np.zeros(1 << (64 - self.shift - 6), np.int64)
        table[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
        self.table = table.view(np.uint64)

    def find(self, seen: np.ndarray) -> np.ndarray:
        """Places in ``seen`` of numbers that may be known."""
        slot = seen >> np.uint64(self.shift)
        bit = self.table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))
        return np.flatnonzero(bit & np.uint64(1))


def _counted(rows: DataFrame, field: str, numbers: DataFrame, sizes: list[int]) -> DataFrame:
    """(number, n): how often each of ``numbers`` occurs in all texts, if at all."""
    sent = rows.sparkSession.sparkContext.broadcast(_Filter(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in textscan.words(batch.column(0), WORD):
                for size in sizes:
                    seen = textscan.shingles(w.number, w.row, size)[0]
                    number, n = np.unique(seen[sent.value.find(seen)], return_counts=True)
                    for lo in range(0, len(number), EMITTED):
                        yield pa.RecordBatch.from_arrays([pa.array(number[lo : lo + EMITTED].view(np.int64)), pa.array(n[lo : lo + EMITTED])], names=["number", "n"])

    texts = rows.select(F.col(f"key.{field}") if field else "text")
    seen = texts.mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    return seen.join(numbers, "number", "left_semi")


def _hits(rows: DataFrame, field: str, prefixes: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """One row (row, key, n_words) per document, then one (row, place, number, before, context) per possible prefix in it.

    ``context``: the words that any window with this prefix can cover, ``before`` of them in front of it."""
    sent = rows.sparkSession.sparkContext.broadcast(_Filter(prefixes))
    key_type = rows.schema["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number_of, key = batch.column(0), batch.column(1)
            text = batch.column(2) if not field else pc.struct_field(key, field)
            for w in textscan.words(text, WORD):
                bounds, n = w.bounds(), w.hi - w.lo
                none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([number_of.slice(w.lo, n), key.slice(w.lo, n), pa.array(np.diff(bounds)), *none], names=names)
                for size in sizes:
                    seen, at = textscan.shingles(w.number, w.row, size)
                    passed = sent.value.find(seen)
                    for lo in range(0, len(passed), EMITTED):
                        k = passed[lo : lo + EMITTED]
                        p = at[k]
                        r = w.row[p]
                        start, end = np.maximum(bounds[r], p - (window - size)), np.minimum(bounds[r + 1], p + window)
                        yield pa.RecordBatch.from_arrays(
                            [
                                number_of.take(pa.array(w.lo + r)), pa.nulls(len(k), key.type), pa.nulls(len(k), pa.int64()),
                                pa.array(p - bounds[r]), pa.array(seen[k].view(np.int64)), pa.array((p - start).astype(np.int32)), _runs(w.number, start, end),
                            ],
                            names=names,
                        )

    found = StructType.fromDDL("n_words long, place long, number long, before int, context binary")
    schema = StructType([rows.schema["row"], StructField("key", key_type.dataType, True), *found.fields])
    names = schema.names
    return rows.mapInArrow(run, schema)


def _spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Inner join whose hot keys on the left are cut into parts by a hash of ``by``; the right's rows of these go to every part.

    A key is hot with more than 1 / ``HOT_PARTS`` of the left's rows, so fewer
    than ``HOT_PARTS`` are broadcast, whatever the data."""
    share = max(1, left.count() // HOT_PARTS)
    counts = left.groupBy(key).agg(F.count("*").alias("count")).where(F.col("count") > F.greatest(F.lit(share), F.lit(EMITTED)))
    hot = F.broadcast(store.written(counts.select(key, F.ceil(F.col("count") / F.lit(max(share, EMITTED))).alias("parts")), "hot"))
    parts = F.coalesce("parts", F.lit(1))
    cut = left.join(hot, key, "left").withColumn("part", F.pmod(F.xxhash64(*by), parts)).drop("parts")
    copied = right.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return cut.join(copied, [key, "part"]).drop("part")


def _with_tables(rows: DataFrame, named: DataFrame, window: int, field: str) -> DataFrame:
    """As :func:`_with_block`, with the items' windows, rarities and prefixes as tables: nothing of them is in the driver but the filters."""
    owned = store.written(_item_windows(named, window).distinct(), "windows")
    windows = owned.select("words").distinct()
    sizes = sorted({min(SHINGLE, r.n) for r in windows.select(F.expr("octet_length(words) div 8").alias("n")).distinct().collect()})
    shingled = store.written(_window_shingles(windows), "shingles")
    known = store.written(shingled.select("number").distinct(), "known")
    often = store.written(_counted(rows, field, known, sizes), "rarity")
    # Prefix of each window: its rarest shingle, the smaller number among equals. A window with one that no text has can't occur.
    ranked = _spread_join(shingled, often, "number", ["words"])
    least = F.min(F.struct("n", "number", "at")).alias("least")
    n_shingles = F.expr(f"greatest(1, octet_length(words) div 8 - {SHINGLE - 1})")
    prefixes = ranked.groupBy("words").agg(least, F.count("*").alias("n_found")).where(F.col("n_found") == n_shingles)
    prefixes = store.written(prefixes.select("words", F.col("least.number").alias("number"), F.col("least.at").alias("at"), F.expr("octet_length(words) div 8").alias("length")), "prefixes")

    hits = store.written(_hits(rows, field, prefixes.select("number").distinct(), sizes, window), "hits")
    # A prefix has at most window x window shapes; each says where the window would lie.
    shapes = prefixes.select("number", "at", "length").distinct()
    placed = _spread_join(hits.where("number is not null").select("row", "place", "number", "before", "context"), shapes, "number", ["row", "place"])
    cut = F.expr("substring(context, cast(8 * (before - at) + 1 as int), cast(8 * length as int))")
    fits = (F.col("before") >= F.col("at")) & (F.octet_length("context") >= 8 * (F.col("before") - F.col("at") + F.col("length")))
    placed = placed.where(fits).select("row", (F.col("place") - F.col("at")).alias("first"), (F.col("place") - F.col("at") + F.col("length")).alias("end"), cut.alias("words"))
    matched = store.written(_spread_join(store.written(placed, "placed"), prefixes.select("words"), "words", ["row", "first"]), "matched")

    # Overlapping or touching spans of a document are one.
    reached = F.max("end").over(Window.partitionBy("row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("first") <= F.col("reached"), 0).otherwise(1)
    run = F.sum("new").over(Window.partitionBy("row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, 0))
    islands = matched.select("row", "first", "end").distinct().withColumn("reached", reached).withColumn("new", new).withColumn("run", run)
    merged = islands.groupBy("row", "run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    spans = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans"))
    pairs = _spread_join(store.written(matched.select("row", "words").distinct(), "found"), owned, "words", ["row"]).select("row", "item").distinct()
    names = pairs.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    every = hits.where("n_words is not null").select("row", "key", "n_words").join(spans, "row", "left").join(names, "row", "left")
    return every.select(
        "row", "key", "n_words",
        F.coalesce("spans", F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)")).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``n_hit``, ``spans`` and ``items``.

    ``key`` may be a struct of the whole row and ``text`` a field of it
    (``doc.text``): the row then travels as that one column.

    ``spans`` are the maximal runs [first, end) of hit words; a word is hit if
    it lies in an occurrence of an item's window. ``items`` are the ids of the
    items with an occurring window, as strings in string order, each once.

    Two narrow passes over the documents (rarity of the items' shingles, then
    the join). Items of up to ``BLOCK_BYTES`` are broadcast and no document is
    shuffled. The windows of more items, their rarities and prefixes are tables:
    places of documents whose shingle passes a filter of the prefixes are joined
    with them by shuffle, hot shingles and windows in parts, and what is found
    meets the documents by row number. Both give the same result.

    Null text has no words; null item text gives no window. Null item ids are
    named ''; rows with the same item id are one item. Null keys, equal keys
    and repeated rows keep a row each. No items: nothing is hit. Other columns
    are left out.
    """
    store.small_batches(docs.sparkSession)
    within = text.startswith(f"{key}.")
    field = text.removeprefix(f"{key}.") if within else ""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), *([] if within else [F.col(text).cast("string").alias("text")]))
    named = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    size = named.agg(F.sum(F.octet_length("text") + F.octet_length("id"))).first()[0] or 0
    if size <= BLOCK_BYTES:
        found = _with_block(rows, [(r.id, r.text) for r in named.collect()], window, field)
    else:
        found = _with_tables(store.written(rows, "documents"), named, window, field)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), "spans", "items")
