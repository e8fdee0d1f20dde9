"""Every query against its oracle; ``MARTKIT_TEST_SF=0.01`` uses the larger tables."""

from __future__ import annotations

import os

import pytest

from martkit.plans.queries import REGISTRY
from tests.oracle import compare, duck

SF_DIR = f"/root/testdata/sf{os.environ.get('MARTKIT_TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_oracle(spark, con, name):
    problem = compare(spark, con, name, SF_DIR)
    if problem == "oracle has no rows" and SF_DIR.endswith("sf0.001"):
        pytest.skip("no rows at this size")
    assert problem is None


def test_every_query_has_an_oracle():
    assert [n for n, q in REGISTRY.items() if q.sql is None] == []


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
