"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from hydrolake.plans import ORACLE_SQL, QUERIES, load_all
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
