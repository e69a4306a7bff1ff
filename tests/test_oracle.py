"""Every registered query against its SQL twin on the given tables."""

import os

import pytest

from checks.catalog import ORACLES, QUERIES
from checks.compare import compare, connect

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
