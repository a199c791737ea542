"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
# The queries for training text have their own tests.
OWN = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert compare(spark, con, DATA, entry.queries()[name], sql) is None


def test_entry(spark):
    rows = {r.rule_seq: r for r in entry.entry(spark).collect()}
    assert len(rows) == 5 and rows[4].success and not rows[3].success


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Look-around, which the engine of the SQL lacks: compared with Python in test_entities.
    assert set(OWN) - set(entry.oracle_sql()) == {"detect_all"}
