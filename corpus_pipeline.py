"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame, which :func:`run` writes and reads again as the
next stage's ``docs``. All stages but the last return the columns of
``documents``, whatever other columns those are, and never change a row.

Null, empty and letterless texts are rejected by the first stage. The stages
after it take whatever reaches them, as their operators' docstrings say:
repeated rows are one group of near duplicates, of which the first row stays;
empty tables go through empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm import decontamination, language, near_duplicates, packing, store

TOKENIZER, END_ID, SEQUENCE = "word_bpe_49k.json", 1, 4096


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told; only texts that are null or have no letter are rejected.

    Without any labelled row nothing can be told apart: every text with a letter is kept then too."""
    model = language.fit(docs.where(~language.held_out("doc_id")), spread="doc_id")
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # The whole row travels as one column, so its other columns can have any name.
    told = language.predict(docs.select(F.struct("*").alias("doc")), model, text="doc.text")
    return told.where(F.col("lang_pred") != language.UNDETERMINED).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest doc_id."""
    # Numbered once: a scan that runs again may be split, and so numbered, in another way.
    rows = store.written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    first = near_duplicates.near_duplicates(rows, key="doc.doc_id", text="doc.text", row="row").where("is_first").select(F.col("row").alias("first_row"))
    return rows.join(first, F.col("row") == F.col("first_row"), "left_semi").select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(docs.select(F.struct("*").alias("doc")), benchmark, key="doc", text="doc.text")
    return found.where("n_hit = 0").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' token pieces into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID, SEQUENCE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: Model scores and token ids can't be written as SQL; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
