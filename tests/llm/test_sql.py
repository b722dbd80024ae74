"""The text queries against their SQL."""

import pytest

from oracle import compare, connect
from patronscope.llm import queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, name):
    difference = compare(QUERIES[name](spark, sf), connect(sf), SQL[name])
    assert difference is None, difference


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
