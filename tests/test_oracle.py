import os

import pytest

from tests.oracle import compare, connect
from oracles import ORACLES
from registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as c:
        yield c


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, con, key):
    compare(spark, con, SF_DIR, key)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
