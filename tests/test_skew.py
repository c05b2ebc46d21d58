"""One group with every row and one event with a third of them."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedarb.operators import arbitrate
from feedarb.params import ArbitrationParams
from feedarb.plans import ordered
from feedarb.sources.landing import land_with_offsets
from tests.model import COPY_SCHEMA

ROWS = 3000


@pytest.fixture(scope="module")
def hot(spark):
    """Offsets with gaps; every third copy belongs to the event ``hot``."""
    rows = [
        (
            "trade",
            "all",
            "hot" if i % 3 == 0 else f"t:{i // 5}",
            f"s{(i * 7) % 11}",
            1_000_000 + i * 1000,
            i * 2 + (i % 2),
        )
        for i in range(ROWS)
    ]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in COPY_SCHEMA.split(", ")])


def test_ranks_lags_and_outcomes(spark, hot):
    df = spark.createDataFrame(hot)
    ranks = arbitrate.arrival_ranks(df, width=64).toPandas().set_index("seq_offset")
    want = hot.set_index("seq_offset")
    by_key = hot.groupby("msg_key")["seq_offset"]
    want["rank"] = (by_key.cumcount() + 1).values
    want["lag"] = (hot["seq_offset"] - by_key.transform("min")).values
    assert ranks["arrival_rank"].sort_index().tolist() == want["rank"].sort_index().tolist()
    assert ranks["lag_offsets"].sort_index().tolist() == want["lag"].sort_index().tolist()
    fates = arbitrate.classify_copies(df).toPandas().set_index("seq_offset")["outcome"].sort_index()
    assert (fates == "forwarded").tolist() == (want["rank"] == 1).sort_index().tolist()
    lags = {r.source_id: (r.copies, r.total_lag) for r in arbitrate.lag_by_source(df).collect()}
    for source, part in want.reset_index().groupby("source_id"):
        assert lags[source] == (len(part), part["lag"].sum())


def test_blocks_stay_bounded(spark, hot, monkeypatch):
    width = 100
    df = spark.createDataFrame(hot)
    blocked = ordered._blocked(df, "seq_offset", width)
    assert blocked.groupBy("stream_type", "symbol", "_block").count().agg(F.max("count")).first()[0] <= width
    numbered = ordered.running_number(df, ["stream_type", "symbol"], "seq_offset", "n", width)
    assert [r.n for r in numbered.orderBy("seq_offset").collect()] == list(range(1, ROWS + 1))


@pytest.mark.parametrize("expected", [3, 11])
def test_records_keep_few_sources_per_event(spark, hot, expected):
    df = spark.createDataFrame(hot)
    record = arbitrate.event_records(df, expected).where("msg_key = 'hot'").first()
    mine = hot[hot["msg_key"] == "hot"]
    firsts = mine.groupby("source_id")["seq_offset"].min().sort_values()
    assert [o for o in record.early] == firsts.tolist()[:expected]
    plan = arbitrate.event_records(df, expected)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    evicted = arbitrate.evictions(df, ArbitrationParams(expected_sources=expected, lag=5), width=64)
    assert evicted.where("msg_key = 'hot' and late_copy").count() == 1


@pytest.mark.parametrize("expected", [1, 11])
def test_records_of_hot_events_and_others_agree(spark, hot, expected):
    """Copies of an event were all shuffled twice, also where an event has few."""
    rows = [*hot.itertuples(index=False, name=None)]
    rows += [("depth", "b", "hot", None if i % 4 == 1 else f"s{i % 4 // 2}", 7 * i, i) for i in range(40)]
    df = spark.createDataFrame(rows, COPY_SCHEMA)
    params = ArbitrationParams(expected_sources=expected, lag=5)
    want = {}
    for hot_copies in (0, 500):
        records = arbitrate.event_records(df, expected, hot_copies).collect()
        plain = sorted(tuple(r)[:-1] for r in records)
        # Where each event leaves, and whether a copy comes after.
        late = sorted(
            (r.msg_key, r.symbol, r.early[expected - 1] is not None and r.last_o > r.early[expected - 1])
            for r in records
        )
        want.setdefault("plain", plain), want.setdefault("late", late)
        assert (plain, late) == (want["plain"], want["late"])
    by_event = df.groupBy("symbol", "msg_key").agg(F.min("seq_offset").alias("o"), F.count("*").alias("n")).collect()
    assert {(r[2], r[0], r[4]) for r in plain} == {(r.symbol, r.msg_key, r.o) for r in by_event}
    assert arbitrate.evictions(df, params, 64).count() == len(by_event)
    gathered = arbitrate._gathered_records(df, expected)._jdf.queryExecution().executedPlan().toString()
    assert gathered.count("Exchange hashpartitioning") == 1


def test_landed_rows_are_written_once(spark, monkeypatch):
    from feedarb.plans import storage
    from feedarb.sources import landing

    written = []
    write = storage.write_table
    monkeypatch.setattr(landing, "write_table", lambda df, label: written.append(df.count()) or write(df, label))
    rows = [("trade", f"s{i % 3}", 100 - i, i) for i in range(90)]
    df = spark.createDataFrame(rows, "stream_type string, symbol string, arr_us bigint, event_id bigint")
    landed = land_with_offsets(df, ("arr_us", "event_id"))
    assert landed.columns == ["stream_type", "symbol", "arr_us", "event_id", "seq_offset"]
    for i in range(3):
        mine = landed.where(f"symbol = 's{i}'").orderBy("arr_us").collect()
        assert [r.seq_offset for r in mine] == list(range(30))
    assert sum(n == 90 for n in written) == 1


def test_partitions_grow_with_the_feed(spark):
    """With a fixed number of partitions a task sorted a fixed part of the feed."""
    from feedarb.plans import storage

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        storage.enough_partitions(spark, 50 << 20)
        plan = spark.range(10).selectExpr("id % 7 as k").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" in plan and ", 100)" in plan
        storage.enough_partitions(spark, 1 << 20)
        assert spark.conf.get(key, None) is None
        spark.conf.set(key, "9")
        storage.enough_partitions(spark, 50 << 20)
        assert spark.conf.get(key) == "9"
    finally:
        spark.conf.unset(key)


def test_landing_with_one_instant(spark):
    rows = [("trade", "all", 7, i, f"v{i}") for i in range(500)] + [("depth", "b", 7, 3, "x")]
    df = spark.createDataFrame(rows, "stream_type string, symbol string, arr_us bigint, event_id bigint, v string")
    landed = land_with_offsets(df.orderBy(F.rand(1)), ("arr_us", "event_id"))
    got = {(r.symbol, r.event_id): r.seq_offset for r in landed.collect()}
    assert got == {**{("all", i): i for i in range(500)}, ("b", 3): 0}


def test_tasks_read_bounded_parts_of_landed_tables(spark):
    """A task sorted as many rows as 128 MB of files hold."""
    from feedarb.plans import storage

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        storage.bounded_tasks(spark)
        rows = storage.durable(spark.range(0, 6_000_000, 1, 1).selectExpr("id * 7919 % 6000011 as a", "xxhash64(id) as b"), "wide")
        own = rows.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
        assert len(own) >= 4 and max(r["count"] for r in own) < 2_000_000
        spark.conf.set(key, "32m")
        storage.bounded_tasks(spark)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.set(key, before)
