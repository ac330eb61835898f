"""Training-data queries that SQL can express, against DuckDB on the small tables."""

import pytest

import __spark_entry__ as E
from checks.compare import compare
from codetrail.llm import queries as Q

from ..conftest import SF_MID, SF_SMALL


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 11))
    assert set(Q.ORACLE_SQL) <= set(Q.QUERIES) and set(Q.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_matches_oracle(spark, sf, name):
    res = compare(spark, sf, [name], verbose=False)[name]
    assert res["status"] == "match", res
