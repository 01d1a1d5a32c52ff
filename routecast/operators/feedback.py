"""Feedback events (X1, X2): JSON payloads of observability events.

:func:`typed_events` parses each JSON column once into a VARIANT and reads the
asked paths into typed columns, which a build writes; X1 and X2 then read
columns. Rows with a payload that is no JSON are kept apart with the reason
(:func:`rejected_events`), so kept and rejected rows add up to the input.

:func:`parse_feedback` works on raw events, for streams and single use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEEDBACK_RECORD = "AGENT_FEEDBACK"

_RECORD = T.StructType([T.StructField("name", T.StringType())])
_VALUE = T.StructType(
    [
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("feedback_message", T.StringType()),
        # as text: the source compares text, and a payload may hold "false" as a string
        T.StructField("positive", T.StringType()),
    ]
)
_ATTRS = T.MapType(T.StringType(), T.StringType())


#: Columns of the typed events: which JSON column and which path in it.
PATHS = {
    "record_name": ("record", "$.name"),
    "user_name": ("resource_attributes", "$['user.name']"),
    "category": ("value", "$.categories[0]"),
    "feedback_message": ("value", "$.feedback_message"),
    # as text: the source compares text, and a payload may hold "false" as a string
    "is_positive": ("value", "$.positive"),
}


def _parsed(events: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``events`` with a VARIANT of each JSON column and ``_problem``, the columns that are no JSON."""
    texts = list(dict.fromkeys(column for column, _ in paths.values()))
    variants = events.select("*", *[F.try_parse_json(F.col(c)).alias(f"_{c}") for c in texts])
    bad = [F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), F.lit(c)) for c in texts]
    return variants.withColumn("_problem", F.concat_ws(",", *bad))


def typed_events(events: DataFrame, paths: dict[str, tuple[str, str]] = PATHS) -> DataFrame:
    """``timestamp`` and a text column for each path, of the events whose JSON columns parse.

    A NULL payload and a path that isn't there give NULL."""
    kept = _parsed(events, paths).filter("_problem = ''")
    return kept.select("timestamp", *[F.try_variant_get(F.col(f"_{c}"), path, "string").alias(name) for name, (c, path) in paths.items()])


def rejected_events(events: DataFrame, paths: dict[str, tuple[str, str]] = PATHS) -> DataFrame:
    """The other events as they came, with ``malformed``: the names of the columns that don't parse, comma-joined."""
    bad = _parsed(events, paths).filter("_problem <> ''")
    return bad.select(*events.columns, F.col("_problem").alias("malformed"))


def feedback_records(typed: DataFrame, record_name: str = FEEDBACK_RECORD, negative_only: bool = False) -> DataFrame:
    """X1 from typed events, without an order."""
    own = typed.filter(F.col("record_name") == record_name)
    out = own.select("timestamp", "user_name", "category", "feedback_message", "is_positive")
    return out.filter(F.col("is_positive") == "false") if negative_only else out


def newest_first(feedback: DataFrame, limit: int | None = None) -> DataFrame:
    """Feedback in X1's order; the newest ``limit`` rows are a top-k (TakeOrderedAndProject)."""
    out = feedback.orderBy(
        F.col("timestamp").desc_nulls_first(), F.col("user_name").asc_nulls_last(), F.col("feedback_message").asc_nulls_last()
    )
    return out.limit(limit) if limit else out


def with_keyword(feedback: DataFrame, pattern: str = "(?i)(wrong|incorrect|mismatch)") -> DataFrame:
    """Feedback whose message matches a keyword pattern, in no order."""
    return feedback.filter(F.col("feedback_message").rlike(pattern))


def parse_feedback(
    events: DataFrame,
    record_name: str = FEEDBACK_RECORD,
    negative_only: bool = False,
    user_key: str = "user.name",
) -> DataFrame:
    """X1 without an order: row-local, usable on a streaming DataFrame. The
    large payloads are parsed only for records of the asked name."""
    own = events.filter(F.from_json("record", _RECORD)["name"] == record_name)
    parsed = own.select(
        "timestamp", F.from_json("resource_attributes", _ATTRS).alias("a"), F.from_json("value", _VALUE).alias("v")
    )
    out = parsed.select(
        "timestamp",
        F.col("a")[user_key].alias("user_name"),
        F.get(F.col("v.categories"), 0).alias("category"),
        F.col("v.feedback_message").alias("feedback_message"),
        F.col("v.positive").alias("is_positive"),
    )
    return out.filter(F.col("is_positive") == "false") if negative_only else out


def extract_feedback(
    events: DataFrame,
    record_name: str = FEEDBACK_RECORD,
    negative_only: bool = False,
    user_key: str = "user.name",
    limit: int | None = None,
) -> DataFrame:
    """X1 newest first: timestamp, user, first category, message and positive
    flag of the feedback records; optionally negative only / the newest
    ``limit`` rows (a top-k, planned as TakeOrderedAndProject). Where no order
    is needed use ``parse_feedback``: an order over all records is a shuffle
    of all records."""
    return newest_first(parse_feedback(events, record_name, negative_only, user_key), limit)


def keyword_feedback(events: DataFrame, pattern: str = "(?i)(wrong|incorrect|mismatch)") -> DataFrame:
    """Negative feedback whose message matches a keyword pattern, in no order."""
    return with_keyword(parse_feedback(events, negative_only=True), pattern)
