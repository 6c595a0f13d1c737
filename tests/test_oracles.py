"""Every registered query against its DuckDB oracle on the smallest data set
(the driver runs the same comparison at sf0.01)."""
import pytest

import __spark_entry__ as E
from syncledger import queries as Q
from syncledger.testing import compare, duck_connect

SMALL = "/root/testdata/sf0.001"

QUERIES = Q.QUERIES  # those of the optional subpackage have tests of their own
ORACLES = Q.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck_connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["file_id", "type", "archive_path", "why", "decision"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert ok, msg
