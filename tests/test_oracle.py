"""Every query of the reference's operators against its DuckDB oracle on the smallest data set."""

import pytest

import __spark_entry__ as E
from checks.compare import compare

from .conftest import SF_SMALL

NAMES = sorted(n for n, f in E.queries().items() if f.__module__ == "checks.spark_queries")


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "builder_code", "volume_usd", "tx_count", "token_transfers_tx",
                          "unique_addresses", "chain_fees_usd"]
    assert df.count() > 0
