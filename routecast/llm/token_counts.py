"""Token counts of whole texts, huge ones by overlap resynchronisation."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.llm import encoding, store

#: Texts encoded together, in rows.
BATCH = 500


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit) of each row.

    Narrow: one pass, no shuffle. Texts beyond ``encoding.CHUNK`` code points
    are encoded in overlapping chunks that are spliced at boundaries proven
    stable, so the memory of a task doesn't follow the longest text's tokens.

    Null text counts as empty (0 bytes, 0 tokens). Null keys, repeated rows
    and equal keys give a row each. An empty table gives no rows. All other
    columns of ``docs`` are left out, whatever their names.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    source = spark.sparkContext.broadcast(encoding.read_tokenizer(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding.encoder(source.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                texts = [t or "" for t in part.column(1).to_pylist()]
                n = [len(ids) // 4 for ids in enc.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64())],
                    names=["key", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
