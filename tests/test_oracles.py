"""Every registered query agrees with its SQL on the driver tables."""

import pytest

from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None
