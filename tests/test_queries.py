"""Every registered query against its SQL, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from eventrank.catalog import load
from tests.compare import check, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, EXPECTED = load()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problems, _, _ = check(spark, con, QUERIES[name], EXPECTED.get(name), FOLDER)
    assert [p for p in problems if p != "no rows"] == []


def test_expected_sql_belongs_to_queries():
    assert set(EXPECTED) <= set(QUERIES)


def test_entry_has_them():
    assert set(QUERIES) <= set(entry.queries()) and set(EXPECTED) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["gold_features", "training_dataset"])
def test_gold_reads_the_given_tables_once(spark, monkeypatch, name):
    """Scans of all jobs count: those of the query and those of what is stored for it. Weather comes from the orders, too."""
    from eventrank.catalog import features

    plans = []

    def kept(df, label, store=features.stored):
        plans.append(df)
        return store(df, label)

    monkeypatch.setattr(features, "stored", kept)
    plans.append(QUERIES[name](spark, FOLDER))
    text = "".join(df._jdf.queryExecution().executedPlan().toString() for df in plans)
    assert text.count("orders.parquet") == 2 and text.count("lineitem.parquet") == 1
