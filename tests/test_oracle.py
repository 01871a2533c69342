"""Every registered query against its SQL."""

import os

import pytest
from oracle import connect, differences

from tidemark.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    if name in catalog.ORACLES:
        assert differences(df, con, catalog.ORACLES[name]) is None
    else:
        assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
