"""Each query with a DuckDB statement against it, on whole tables."""

from __future__ import annotations

import duckdb
import pytest

from roadpulse.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_statement(spark, name):
    got = registry.queries()[name](spark, SF)
    with duckdb.connect() as db:
        for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
            db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
        want = db.execute(registry.oracle_sql()[name])
        names, answer = [c[0] for c in want.description], want.fetchall()
    assert got.columns == names
    rows = [sorted(map(str, map(tuple, x))) for x in (got.collect(), answer)]
    assert rows[0] == rows[1] and len(rows[0])


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in registry.queries()}
    assert numbers == set(range(1, 14))
