"""Registered queries against their SQL, and that each is there."""

import pytest

from checks.compare import connect, difference
from farelane.llm.queries import llm_queries
from farelane.llm.sql import llm_sql


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in llm_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_matches_sql(spark, small, name):
    got = llm_queries()[name](spark, small).toPandas()
    assert difference(got, connect(small).execute(llm_sql()[name]).df()) == ""
