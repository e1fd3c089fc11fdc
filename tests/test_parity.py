"""Every registered query against its check SQL (sf0.001; PARITY_SF_DIR for another size)."""

import os

import pytest

from parity import compare, duck
from visitry.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
MODELS = [k for k in QUERIES if k not in ORACLES]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", list(ORACLES))
def test_parity(spark, con, key):
    problem, _ = compare(spark, con, SF_DIR, QUERIES[key], ORACLES[key])
    assert problem is None


@pytest.mark.parametrize("key", MODELS)
def test_models_run(spark, key):
    assert QUERIES[key](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["member_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_reads_a_part_of_its_tables():
    """Check SQL must not thin its tables by id arithmetic."""
    import re

    from visitry.catalog.bindings import BINDINGS

    for name, sql in BINDINGS.items():
        where = re.sub(r"CASE.*?END", "", sql.split("WHERE")[-1]) if "WHERE" in sql else ""
        assert not re.search(r"\w %+ \d", where), name
        assert "LIMIT" not in sql, name
