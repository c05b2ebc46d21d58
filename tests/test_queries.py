"""Every registered query against its SQL, and plan properties."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from feedarb.plans import audit_oracles, reports
from tests.compare import compare

#: Reports on copies that must not read their payloads.
WITHOUT_PAYLOADS = {"slowest_source", "copy_classification", "arrival_ranks", "evictions", "window_wins", "gate_closures"}
SF_DIR = "/root/testdata/sf0.001"
SQL = audit_oracles.oracle_sql()
QUERIES = reports.queries()


def test_every_oracle_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF_DIR, QUERIES[name], SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 9


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_distributed(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "Python", "InPandas"):
        assert node not in plan
    if name in WITHOUT_PAYLOADS:
        assert "value#" not in plan


def test_session_time_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert compare(spark, SF_DIR, reports.tumbling_leaderboard, SQL["tumbling_leaderboard"]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
