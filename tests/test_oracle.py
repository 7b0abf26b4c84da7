"""Every query against the same result in SQL, on the given tables."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from acceptance.oracle import oracle_sql
from acceptance.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    integers = {"tinyint", "smallint", "int", "integer", "bigint"}
    return "integer" if dtype in integers else {"varchar": "string"}.get(dtype, dtype.replace(" ", ""))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: _kind(str(d[1])) for d in cursor.description}
    order = sorted(columns)
    assert sorted(result.columns) == order
    assert {c: _kind(t) for c, t in result.dtypes} == types
    expected = Counter(tuple(row[columns.index(c)] for c in order) for row in cursor.fetchall())
    actual = Counter(tuple(row[c] for c in order) for row in result.collect())
    assert actual or SF_DIR.endswith("sf0.001"), "no rows"
    assert actual - expected == Counter() and expected - actual == Counter()


def test_every_query_has_an_oracle():
    """Of the lake's own queries; those of the training-data operators have theirs, or brute force in their tests."""
    assert set(QUERIES) == set(oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
