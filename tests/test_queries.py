"""Every registered query against its oracle SQL on the smallest data set."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql
from changefeed.queries import REGISTRY
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, REGISTRY[name], oracle_sql()[name])
    assert ok, note
