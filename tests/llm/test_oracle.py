"""Queries that SQL can express, against DuckDB on the given tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == Counter(cursor.fetchall())
