"""Every registered query against its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tools.oracle_compare import compare, duck  # noqa: E402

from seatcast import oracle  # noqa: E402
from seatcast.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(oracle.all_sql()) == set(registry.queries())
    assert set(E.oracle_sql()) <= set(E.queries()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF, registry.queries(), oracle.all_sql(), con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert not r["type_diffs"], r
    assert r["close"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["genre", "venue_city", "days_bucket", "bucket_order",
                          "num_observations", "mean_price", "median_price",
                          "lowest_price_seen", "highest_price_seen"]
