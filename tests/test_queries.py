"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
from checking import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LLM = contract.llm.QUERIES if contract.llm else {}
QUERIES = {k: v for k, v in contract.queries().items() if k not in LLM}
SQL = {k: v for k, v in contract.oracle_sql().items() if k not in LLM}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, db):
    assert difference(QUERIES[name](spark, SF_DIR), db, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
