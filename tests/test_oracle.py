"""Every catalog query with oracle SQL equals DuckDB on the same parquet (sf0.01)."""

import pytest

from conftest import SF01
from oracle_harness import compare, duck_connect
from netsieve.plans import catalog

O_KEYS = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF01)


@pytest.mark.parametrize("key", O_KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, SF01, con)
    assert r["ok"], r


def test_every_key_registered():
    q = catalog.queries()
    assert set(catalog.oracle_sql()) <= set(q)
    assert len(q) >= 75
