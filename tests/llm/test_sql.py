"""Operator queries against their SQL."""

from __future__ import annotations

import pytest

from larder.llm import queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_operator_sql(spark, name):
    ok, message = compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, message
