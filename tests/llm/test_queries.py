"""Queries that SQL can express, against it."""

from __future__ import annotations

import pytest

from feedarb.llm import queries
from tests.compare import compare

SQL = queries.oracle_sql()


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", queries.queries()[name], SQL[name]) is None
