"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, registry
from larder.storage import remove_staged
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    ok, message = compare(spark, duck, SF, name, registry.QUERIES[name], registry.ORACLES.get(name))
    remove_staged(spark)
    assert ok, message


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    assert {r.source: r.total for r in entry(spark).collect()}
