"""Every registered query against its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from duckdb_oracle.compare import compare, duck

SF = "/root/testdata/sf0.001"
# the training-data queries are tested beside their subpackage, which may be absent
QUERIES = {k: f for k, f in entry.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
ORACLE = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}
#: Checks that the tables at hand pass: an empty result on both sides.
MAY_BE_EMPTY = {"D1_duplicate_booking_ids", "D2_incidents_without_trip", "D3_orphan_fact_vehicles"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert res["ok"], res
    assert res["spark_rows"] or name in MAY_BE_EMPTY


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["route_name", "on_time_rate"]
