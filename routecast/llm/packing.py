"""Best-fit decreasing packing of token pieces into sequences of a fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.llm import encoding, store

BATCH = 500
#: Pieces that one task packs together. Each group leaves at most a few open
#: sequences, so the loss against one global packing is about one sequence in
#: tens of thousands; a task's memory is bounded by this number.
GROUP_ROWS = 1 << 16


class _OpenBins:
    """A segment tree over remaining capacities 0..size; a leaf stacks the open bins of that capacity.

    A node counts the bins below it, so the tightest bin that still takes
    ``need`` tokens is found by one climb and one descent: O(log size).
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, leaf: int, by: int) -> None:
        node = leaf + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, bin_id: int) -> None:
        if not self.bins[room]:
            self._add(room, 1)
        self.bins[room].append(bin_id)

    def take(self, need: int) -> tuple[int, int] | None:
        """The room and id of the tightest bin with at least ``need`` room, removed from the tree."""
        count, node = self.count, need + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        bin_id = self.bins[room].pop()
        if not self.bins[room]:
            self._add(room, -1)
        return room, bin_id


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (0..size): longest first, each into the tightest open bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, made = _OpenBins(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None and need == 0 and made:
            found = 0, made - 1  # all bins are full, and hold nothing more
        room, at = found if found else (size, made)
        made += found is None
        bins[i], offsets[i] = at, size - room
        if room > need:
            tree.put(room - need, at)
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The token pieces of each row: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A row's ids are those of its whole text plus ``end_id``; only rows longer
    than ``size`` are cut, into pieces of ``size`` (the last may be shorter).
    Narrow: one pass over the texts, no shuffle.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    source = spark.sparkContext.broadcast(encoding.read_tokenizer(tokenizer_path))
    tail, step = int(end_id).to_bytes(4, "little"), 4 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding.encoder(source.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                rows = batch.slice(lo, BATCH)
                row, at, crc, n, ids = [], [], [], [], []
                for i, got in enumerate(enc.encode([t or "" for t in rows.column(1).to_pylist()])):
                    got += tail
                    for a in range(0, len(got), step):
                        cut = got[a : a + step]
                        row.append(i)
                        at.append(a // 4)
                        crc.append(zlib.crc32(cut))
                        n.append(len(cut) // 4)
                        if with_ids:
                            ids.append(np.frombuffer(cut, "<i4"))
                start = np.array(at, np.int64)
                cols = [rows.column(0).take(pa.array(row, pa.int64())), pa.array((start // size).astype(np.int32)), pa.array(start), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=["key", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def pack(items: DataFrame, length: str = "length", size: int = 4096, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to each row of ``items``, whose lengths are 0..size.

    Best-fit decreasing inside groups of about ``group_rows`` rows. The groups
    are drawn by a hash of the row's number in the written table, not of any
    column: a key or a length that many rows share doesn't gather anywhere,
    each group has the table's mix of lengths, and a retried task deals alike.

    A null length counts as 0; a length beyond ``size`` is an error. Columns of
    ``items`` named like the added ones are replaced. An empty table gives no
    rows; equal rows are packed one by one.
    """
    added = {"sequence_id", "offset", "_row", "_group"}
    kept = [c for c in items.columns if c not in added]
    table = store.written(items.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "pack")
    groups = max(1, -(-table.count() // group_rows))

    def run(group: tuple, rows: pa.Table) -> pa.Table:
        lengths = rows[length].fill_null(0).to_numpy().astype(np.int64)
        if len(lengths) and (lengths.max() > size or lengths.min() < 0):
            raise ValueError(f"a length is outside 0..{size}")
        bins, offsets = best_fit_decreasing(lengths, size)
        out = rows.select(kept).append_column("sequence_id", pa.array((group[0].as_py() << 32) + bins))
        return out.append_column("offset", pa.array(offsets))

    dealt = table.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("long"))
    fields = ", ".join(f"`{c}` {items.schema[c].dataType.simpleString()}" for c in kept)
    return dealt.groupBy("_group").applyInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 4096, key: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every row's pieces with their sequence and their place in it (gapless from 0 in each sequence).

    Null text is empty: one piece with the end id alone. See :func:`pack` and
    :func:`token_pieces`.
    """
    return pack(token_pieces(docs, tokenizer_path, end_id, size, key, text), "length", size, group_rows)
