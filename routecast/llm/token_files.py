"""Token ids as Parquet list columns: written in key order, read selectively.

File format: Parquet version 2 pages. ``ids`` is a list column with dictionary
encoding (a vocabulary fits the dictionary page, so an id costs its bits of
the vocabulary size or less). ``n_tokens`` and ``local_start`` use delta
encoding. Row groups and pages are small and have a page index, so that a
read of some keys or of the metadata alone skips the id pages. A manifest
table beside the data has one row for each file: its key range, its number of
rows and ids, and the ids before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routecast.llm import encoding, store

BATCH = 500
#: Bytes of a row group, of a page and of the dictionary; rows of a page.
ROW_GROUP, PAGE, DICTIONARY, PAGE_ROWS = 16 << 20, 256 << 10, 1 << 20, 2000


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = None,
    partitions: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text and write the ids in ascending key order under ``path``.

    The texts are dealt by ranges of (key, hash of the text, row number): one
    shuffle, of texts rather than of ids, and a key that many rows share is
    still split. Each task encodes its sorted range and streams it to its
    file. ``partitions`` defaults to the session's shuffle partitions.

    Null text is empty and has the end id alone. Null keys come first.
    Rows with equal keys stay separate rows next to each other. An empty table
    gives a store without rows. Other columns are left out.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    source = spark.sparkContext.broadcast(encoding.read_tokenizer(tokenizer_path))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoding.encoder(source.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                rows = batch.slice(lo, BATCH)
                ids = [x + tail for x in enc.encode([t or "" for t in rows.column(1).to_pylist()])]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), pa.ListArray.from_arrays(ends, values)],
                    names=["key", "part", "local_start", "n_tokens", "ids"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("row")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, part int, local_start long, n_tokens long, ids array<int>"
    (
        dealt.mapInArrow(run, schema)
        .withColumnRenamed("key", key)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.size", PAGE)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.dictionary.page.size", DICTIONARY)
        .option("parquet.enable.dictionary#local_start", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("compression", "zstd")
        .parquet(f"{path}/data")
    )
    files = spark.read.parquet(f"{path}/data").groupBy("part").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_ids")
    )
    # One row for each written file: this window's single task grows with the files, not with the rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The key, ``start`` (ids of all rows before), ``n_tokens`` and, if asked for, ``ids``.

    Without ids only the metadata columns are read. A filter on the key
    reaches the scan, whose row groups and pages carry key ranges.
    """
    data = spark.read.parquet(f"{path}/data")
    files = spark.read.parquet(f"{path}/manifest").select(F.col("part").alias("_part"), F.col("start").alias("_before"))
    out = data.join(files, data["part"] == F.col("_part")).withColumn("start", F.col("local_start") + F.col("_before"))
    return out.select(data.columns[0], "start", "n_tokens", *(["ids"] if with_ids else []))


def with_crc32(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """Adds ``ids_crc32``: unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers; drops ``ids``."""
    keep = [c for c in rows.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, ids).mapInArrow(run, f"{fields}, ids_crc32 long")
