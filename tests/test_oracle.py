"""Every registered query against its SQL on the test tables."""

import os

import pytest

import __spark_entry__ as contract
from trenchbook.plans.queries import QUERIES as OWN
from tests.compare import database, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in contract.queries().items() if n in OWN}
SQL = {n: q for n, q in contract.oracle_sql().items() if n in OWN}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
