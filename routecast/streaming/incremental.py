"""Incremental runs of row-local operators with Structured Streaming.

The reference is batch only. Its staging layer and the feedback extraction
are row-local (no aggregation, no ordering), so the same functions can be
applied to a file stream: new raw files are staged as they land and
appended to the staged table, with exactly-once bookkeeping in a checkpoint
under the shared scratch folder. Aggregating layers stay batch (they are
full rebuilds in the reference).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from routecast.operators.feedback import parse_feedback
from routecast.operators.staging import stg_delay_incidents, stg_scheduled_trips, stg_trips
from routecast.session import scratch_dir
from routecast.sources.schemas import FEEDBACK_EVENTS, RAW_DELAY_INCIDENTS, RAW_SCHEDULED_TRIPS, RAW_TRIPS

STREAMABLE: dict[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]] = {
    "stg_delay_incidents": (RAW_DELAY_INCIDENTS, stg_delay_incidents),
    "stg_scheduled_trips": (RAW_SCHEDULED_TRIPS, stg_scheduled_trips),
    "stg_trips": (RAW_TRIPS, stg_trips),
    "negative_feedback": (FEEDBACK_EVENTS, lambda df: parse_feedback(df, negative_only=True)),
}


def start_incremental(
    spark: SparkSession,
    name: str,
    source_dir: str,
    sink_dir: str,
    source_format: str = "parquet",
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Stage new files of ``source_dir`` into ``sink_dir`` (parquet, append).

    ``available_now`` processes everything present and stops (a scheduled
    incremental batch); otherwise the query keeps running."""
    schema, fn = STREAMABLE[name]
    reader = spark.readStream.schema(schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = fn(reader.load(source_dir))
    ckpt = checkpoint or f"{scratch_dir(spark)}/streams/{name}"
    writer = staged.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
