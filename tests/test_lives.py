"""All lives of events against the literal model and against SQL that walks copy by copy."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedarb.operators import lives
from feedarb.params import ArbitrationParams
from feedarb.plans import life_oracles, life_reports
from feedarb.sources.landing import GROUP
from tests.compare import compare
from tests.model import COPY_SCHEMA, as_rows, random_feed, simulate

SQL = life_oracles.oracle_sql()
QUERIES = life_reports.queries()


def build(spark, repeat, sources=5, seeds=range(4), events=90):
    feeds = {("trade" if s % 2 else "depth", f"sym{s}"): random_feed(s, events, sources, repeat) for s in seeds}
    rows = [r for (stream, symbol), feed in feeds.items() for r in as_rows(feed, stream, symbol)]
    return feeds, spark.createDataFrame(rows, COPY_SCHEMA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_report_equals_sql(spark, name):
    assert compare(spark, "/root/testdata/sf0.001", QUERIES[name], SQL[name]) is None


def test_every_report_has_sql():
    import __spark_entry__ as entry

    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize(
    "expected,lag,sources,width",
    [(1, 5, 4, 7), (2, 3, 5, 48), (5, 12, 6, 96), (5, 12, 6, 1 << 17), (3, 1, 5, 32), (5, 400, 5, 300)],
)
def test_equals_model(spark, expected, lag, sources, width):
    params = ArbitrationParams(expected_sources=expected, lag=lag, lag_by_stream={"depth": 4})
    feeds, copies = build(spark, 0.3, sources, seeds=range(2))
    found = lives.lives(copies, params, width=width)
    fates = lives.outcomes(copies, found).collect()
    gone = lives.evictions(found).collect()
    pending = found.pending.collect()
    counted = {(r.stream_type, r.symbol): r for r in lives.feed_counters(copies, found).collect()}
    for (stream, symbol), feed in feeds.items():
        run = simulate(feed, params, params.lag_for(stream), removal=False)

        def mine(rows):
            return [r for r in rows if (r.stream_type, r.symbol) == (stream, symbol)]

        assert sorted((r.seq_offset, r.outcome) for r in mine(fates)) == sorted(run.fates)
        assert sorted(
            (r.msg_key, r.winner, r.copies_seen, r.complete, r.evict_offset, r.evict_us) for r in mine(gone)
        ) == sorted(run.evictions)
        numbers = {offset: n for n, offset in enumerate(sorted(run.forwarded), 1)}
        assert all(numbers[r.first_offset] == r.admitted_seq for r in mine(gone))
        assert sorted(r.msg_key for r in mine(pending)) == sorted(run.cached)
        row = counted[stream, symbol]
        assert (row.consumed, row.forwarded, row.ignored) == (len(feed), len(run.forwarded), 0)


def test_wrong_guesses_are_walked_through_again(spark):
    """Entries that live long before their block, so that no guess can know them."""
    params = ArbitrationParams(expected_sources=3, lag=6)
    feed = [(o, 1_000_000 * o, f"t:{o % 4}", "s0") for o in range(120)] + [(120, 120_000_000, "t:1", "s1")]
    copies = spark.createDataFrame(as_rows(feed), COPY_SCHEMA)
    found = lives.lives(copies, params, width=40)
    run = simulate(feed, params, 6, removal=False)
    assert sorted(r.seq_offset for r in lives.forwarded(copies, found).collect()) == run.forwarded == [0, 1, 2, 3]
    assert {(r.msg_key, r.first_offset, r.copies_seen) for r in found.pending.collect()} == {
        ("t:0", 0, 1), ("t:1", 1, 2), ("t:2", 2, 1), ("t:3", 3, 1),
    }


def test_ignored_sources_reach_no_cache(spark):
    params = ArbitrationParams(expected_sources=5, lag=12)
    feeds, copies = build(spark, 0.3, 6, seeds=range(2))
    half = {group: feed[len(feed) // 2][1] for group, feed in feeds.items()}
    gone = spark.createDataFrame([(*g, "s1", us) for g, us in half.items()], "stream_type string, symbol string, source_id string, from_us bigint")
    fates = lives.outcomes(copies, lives.lives(copies, params, gone, width=32)).collect()
    for group, feed in feeds.items():
        kept = [row for row in feed if not (row[3] == "s1" and row[1] >= half[group])]
        run = simulate(kept, params, 12, removal=False)
        got = {r.seq_offset: r.outcome for r in fates if (r.stream_type, r.symbol) == group}
        assert got == {o: "ignored" for o, *_ in feed} | dict(run.fates)


def test_hot_event_and_empty_feed(spark):
    params = ArbitrationParams(expected_sources=4, lag=3)
    feed = [(o, 1_000 * o, "t:hot" if o % 3 else f"t:{o}", f"s{o * o % 5}") for o in range(3000)]
    copies = spark.createDataFrame(as_rows(feed), COPY_SCHEMA)
    found = lives.lives(copies, params, width=512)
    run = simulate(feed, params, 3, removal=False)
    assert sorted(r.seq_offset for r in lives.forwarded(copies, found).collect()) == run.forwarded
    none = lives.lives(copies.where(F.lit(False)), params)
    assert none.copies.count() == none.pending.count() == 0
    assert lives.pending_entries(copies, none).select(*GROUP, "pending").collect()[0].pending == 0


def test_entries_see_many_copies_in_one_call_as_one_by_one():
    for seed, lag, expected in ((1, 3, 2), (2, 12, 5), (3, 1, 1), (4, 40, 3)):
        feed = random_feed(seed, 200, 5, 0.3)
        offsets, times, keys, sources = (list(column) for column in zip(*feed))
        together = lives.LiveEntries(expected, lag)
        forwarded, places, left = together.see(keys, sources, offsets, times)
        apart = lives.LiveEntries(expected, lag)
        steps = [apart.see([k], [s], [o], [u]) for o, u, k, s in feed]
        assert forwarded == [step[0][0] for step in steps]
        assert places == [n for n, step in enumerate(steps) if step[1]]
        assert left == [gone for step in steps for gone in step[2]]
        assert together.told() == apart.told() == lives.LiveEntries(expected, lag, apart.told()).told()
        run = simulate(feed, ArbitrationParams(expected_sources=expected, lag=lag), lag, removal=False)
        assert [o for o, new in zip(offsets, forwarded) if new] == run.forwarded


def test_blocks_that_take_turns_are_told_apart():
    import pyarrow as pa

    rows = [("t", "a", 0, 1), ("t", "b", 0, 1), ("d", "a", 0, 2), ("t", "a", 0, 3), ("t", "a", 1, 4), ("t", "b", 0, 5)]
    names = ["stream_type", "symbol", "block", "seq_offset"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows])
    got = {block: part.column("seq_offset").to_pylist() for block, part in lives._by_block(batch)}
    assert got == {("t", "a", 0): [1, 3], ("t", "b", 0): [1, 5], ("d", "a", 0): [2], ("t", "a", 1): [4]}


def test_headers_of_a_message_are_read_once(spark):
    """Plain projections were copied into the filter and into each use of a name."""
    from feedarb.operators import ingest
    from feedarb.sources import derived

    good = ingest.validate_raw(derived.raw_copies(spark, "/root/testdata/sf0.001")).where("drop_reason is null")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 1
