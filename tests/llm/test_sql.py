"""Queries that SQL can express, beside their SQL."""

import pytest

from checks import compare
from parcelframe.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, data, name):
    assert compare.differences(QUERIES[name](spark, data), compare.connect(data), SQL[name]) == []
