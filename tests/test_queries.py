"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from postquarry.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_every_query_equals_its_sql(spark):
    from check_oracle import compare

    assert compare(spark, SF, []) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert all(q.sql and oracle_sql()[name] == q.sql for name, q in QUERIES.items())


def test_entry(spark):
    assert entry(spark).count() > 0
