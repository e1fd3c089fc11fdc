"""Queries with check SQL, on the smallest tables."""

import pytest
from parity import compare, duck

from visitry.llm.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(ORACLES))
def test_parity(spark, key):
    problem, _ = compare(spark, duck(SMALL), SMALL, QUERIES[key], ORACLES[key])
    assert problem is None
