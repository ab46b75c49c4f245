"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from check import compare, connect
from cellmeter.plans.oracles import ORACLES
from cellmeter.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["trace_id", "slot", "waiting", "tx", "retx"]
