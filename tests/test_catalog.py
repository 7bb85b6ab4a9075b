"""Every registered query against DuckDB on the smallest tables; queries without SQL must give rows."""

import pytest

from quarrymill.catalog import ORACLES, QUERIES
from tests.oracle import DATA, compare, connect

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, n = compare(spark, con, FOLDER, QUERIES[name], ORACLES.get(name))
    assert message is None
    assert n > 0
