"""Queries that SQL can state, on the smallest data set; all queries for their columns."""

import pytest

from eventrank.llm import queries
from tests.compare import duck, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, EXPECTED = queries.load()


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    result = duck(FOLDER).execute(EXPECTED[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(names, result.fetchall())


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(EXPECTED) < set(QUERIES)
