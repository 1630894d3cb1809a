"""Every registered query against its independent DuckDB statement."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as registry
from fleet_points import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DUCK_TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}

ORACLES = registry.oracle.statements()
# the corpus queries, if present, have tests of their own
QUERIES = {
    name: query
    for name, query in registry.queries().items()
    if name in ORACLES or not re.match(r"op\d+_|pipeline$", name)
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_duckdb(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)

    answer = duck.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in answer.description}
    places = [list(kinds).index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in answer.fetchall()), key=repr)

    assert sorted(kinds) == columns
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in result.schema} == kinds
    assert ours == theirs
    assert ours


def test_flagship_is_not_empty(spark):
    assert registry.entry(spark).count() > 0
