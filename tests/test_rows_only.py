"""Queries without an oracle run end to end and return rows (sf0.001)."""

import pytest

from conftest import SF001
from netsieve.plans import catalog

R_KEYS = sorted(set(catalog.queries()) - set(catalog.oracle_sql()))


@pytest.mark.parametrize("key", R_KEYS)
def test_runs(spark, key):
    df = catalog.queries()[key](spark, SF001)
    assert len(df.columns) > 0
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"label", "n", "avg_bytes_per_sec"}
