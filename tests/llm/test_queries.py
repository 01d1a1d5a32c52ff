"""The registered queries: names, columns, and DuckDB where SQL can express them."""

from __future__ import annotations

import os

import pytest

from routecast.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op2": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op3": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op6": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op8": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op11": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op10": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
}


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    assert dict(QUERIES[name](spark, SF).dtypes) == COLUMNS[name.split("_")[0]]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        assert os.path.exists(f"{SF}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect())))
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())
