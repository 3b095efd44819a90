"""Every query with SQL gives the same values in both engines."""

import pytest
from oracle import compare, connect

from conftest import MEDIUM, SMALL
from tillsight.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    # Model studies need spenders in every segment; the smallest data has too few.
    folder = MEDIUM if name.startswith("m_") else SMALL
    df = QUERIES[name](spark, folder)
    assert df.columns and len(df.collect()) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
