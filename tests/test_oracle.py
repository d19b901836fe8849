"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import DATA

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(DATA)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    result = QUERIES[name](spark, data).toArrow()
    assert result.num_rows >= 0
    if name in ORACLES:
        assert difference(result, duck.sql(ORACLES[name]).to_arrow_table()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
