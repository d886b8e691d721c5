"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from acceptance.queries import registered

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(registered()) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect())
    answer = duck.execute(ORACLE[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in answer.fetchall())
    assert sum(ours.values()) > 0
    only_ours, only_theirs = ours - theirs, theirs - ours
    assert not only_ours and not only_theirs, (
        list(only_ours.items())[:3],
        list(only_theirs.items())[:3],
    )


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 25
