"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from checks import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES
from nearkin.sources.scratch import clear_scratch

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert compare.difference(spark, name, SF_DIR, connection) is None
    clear_scratch(spark)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 10
    assert set(contract.oracle_sql()) <= set(contract.queries())
