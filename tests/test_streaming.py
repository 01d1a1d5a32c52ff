"""Incremental staging over a file stream equals batch staging."""

from __future__ import annotations

import tempfile

from routecast.operators.staging import stg_delay_incidents
from routecast.sources import testdata
from routecast.streaming.incremental import start_incremental
SF_SMALL = "/root/testdata/sf0.001"


def test_incremental_incident_staging_matches_batch(spark):
    raw = testdata.raw_delay_incidents(testdata.read_table(spark, SF_SMALL, "events"))
    src, sink, ckpt = (tempfile.mkdtemp(prefix=f"rc-stream-{p}-") for p in ("src", "sink", "ckpt"))
    half = raw.filter("cast(substr(incident_id, 2) as int) % 2 = 0")
    half.write.mode("append").parquet(src)
    q = start_incremental(spark, "stg_delay_incidents", src, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(sink).count()
    assert first == stg_delay_incidents(half).count()
    # a second file batch lands; the next incremental run picks up only it
    raw.subtract(half).write.mode("append").parquet(src)
    q = start_incremental(spark, "stg_delay_incidents", src, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = stg_delay_incidents(raw)
    assert streamed.count() == batch.count()
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_negative_feedback_stream(spark):
    fb = testdata.raw_feedback_events(testdata.read_table(spark, SF_SMALL, "events"))
    src, sink, ckpt = (tempfile.mkdtemp(prefix=f"rc-fb-{p}-") for p in ("src", "sink", "ckpt"))
    fb.write.mode("append").json(src)
    q = start_incremental(spark, "negative_feedback", src, sink, source_format="json", checkpoint=ckpt)
    q.awaitTermination(120)
    from routecast.operators.feedback import parse_feedback

    assert spark.read.parquet(sink).count() == parse_feedback(fb, negative_only=True).count()
