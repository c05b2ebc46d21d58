"""Closed-form arbitration and windows against the literal model."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedarb.operators import arbitrate, tally, windows
from feedarb.params import ArbitrationParams
from feedarb.sources.landing import GROUP
from tests.model import COPY_SCHEMA, as_rows, random_feed, simulate

LAGS = {"trade": 12, "depth": 3}


def build(spark, repeat, sources=5, seeds=range(4)):
    """Several groups at once: two streams with different lags."""
    feeds = {}
    for seed in seeds:
        stream = "trade" if seed % 2 else "depth"
        feeds[(stream, f"sym{seed}")] = random_feed(seed, 90, sources, repeat)
    rows = [r for (stream, symbol), feed in feeds.items() for r in as_rows(feed, stream, symbol)]
    return feeds, spark.createDataFrame(rows, COPY_SCHEMA)


@pytest.mark.parametrize("expected", [1, 2, 5])
@pytest.mark.parametrize("repeat", [0.0, 0.3])
def test_first_life_equals_model(spark, expected, repeat):
    params = ArbitrationParams(expected_sources=expected, lag=12, lag_by_stream={"depth": 3})
    feeds, copies = build(spark, repeat)
    got = arbitrate.evictions(copies, params, width=8).collect()
    certificate = {
        (r.stream_type, r.symbol): r.readmitted_keys
        for r in arbitrate.certificate(arbitrate.evictions(copies, params, width=8)).collect()
    }
    for group, feed in feeds.items():
        mine = [r for r in got if (r.stream_type, r.symbol) == group]
        run = simulate(feed, params, LAGS[group[0]], removal=False)
        lives = len(run.forwarded) - len({key for _, _, key, _ in feed})
        assert (certificate[group] == 0) == (lives == 0)
        if lives:
            continue
        assert sorted(
            (r.msg_key, r.winner, r.copies_seen, r.complete, r.evict_offset, r.evict_us)
            for r in mine
            if r.evict_offset is not None
        ) == sorted(run.evictions)
        assert sorted(r.msg_key for r in mine if r.evict_offset is None) == sorted(run.cached)


def test_certificate_counts_second_lives_with_more_sources_than_expected(spark):
    params = ArbitrationParams(expected_sources=3, lag=50)
    feeds, copies = build(spark, 0.0, sources=5)
    rows = arbitrate.certificate(arbitrate.evictions(copies, params)).collect()
    for row in rows:
        feed = feeds[(row.stream_type, row.symbol)]
        run = simulate(feed, params, 50, removal=False)
        assert row.readmitted_keys > 0
        assert len(run.forwarded) > row["keys"]


@pytest.mark.parametrize("window", [7, 4.5])
def test_observe_mode_equals_model_without_removal(spark, window):
    params = ArbitrationParams(
        expected_sources=5,
        window_seconds=window,
        minimum_events=6,
        emit_tally_every=4,
        lag=300,
    )
    feeds, copies = build(spark, 0.0)
    sources = windows.roster(copies)
    gates = windows.gate_opening(sources, params.expected_sources)
    evicted = arbitrate.evictions(copies, params, width=8)
    credit = windows.credited(evicted, gates, params)
    wins = tally.window_wins(credit, sources, gates, params)
    keys = [*GROUP, "window_no"]
    said = (
        tally.verdicts(wins, keys, params.minimum_events)
        .join(tally.counts_map(wins, keys), keys)
        .join(windows.observe_windows(gates, params), keys)
        .collect()
    )
    tallies = tally.running_tallies(credit, sources, params, width=4).collect()
    checked = 0
    for group, feed in feeds.items():
        run = simulate(feed, params, params.lag, removal=False)
        if len(run.forwarded) != len({key for _, _, key, _ in feed}):
            continue
        checked += 1
        mine = sorted(
            (r.window_start_us, r.window_end_us, r.slowest_source_id, r.counts, r.total_events, r.reason)
            for r in said
            if (r.stream_type, r.symbol) == group
        )
        assert mine == sorted(run.verdicts, key=lambda v: v[:2])
        shown = {}
        for r in tallies:
            if (r.stream_type, r.symbol) == group:
                shown.setdefault((r.emitted_us, r.total_events), {})[r.source_id] = r.wins
        assert shown == {(at, total): counts for at, _, counts, total in run.tallies}
    assert checked


def test_classification_and_ranks(spark):
    feeds, copies = build(spark, 0.3)
    fates = arbitrate.classify_copies(copies)
    ranks = arbitrate.arrival_ranks(copies, width=8)
    joined = fates.join(ranks.select(*GROUP, "seq_offset", "arrival_rank", "lag_offsets"), [*GROUP, "seq_offset"])
    assert joined.count() == copies.count()
    wrong = joined.where((F.col("outcome") == "forwarded") != (F.col("arrival_rank") == 1))
    assert wrong.count() == 0
    assert joined.where((F.col("arrival_rank") == 1) != (F.col("lag_offsets") == 0)).count() == 0
    assert fates.where("outcome = 'forwarded'").count() == copies.select(*arbitrate.KEY).distinct().count()


def test_ignored_sources_never_win(spark):
    feeds, copies = build(spark, 0.0)
    gone = copies.select(*GROUP).distinct().select(
        *GROUP, F.lit("s0").alias("source_id"), F.lit(0).cast("bigint").alias("from_us")
    )
    flagged = arbitrate.flag_ignored(copies, gone)
    fates = arbitrate.classify_copies(flagged)
    assert fates.where("source_id = 's0' and outcome <> 'ignored'").count() == 0
    firsts = arbitrate.first_copies(arbitrate.drop_ignored(copies, gone))
    assert firsts.where("source_id = 's0'").count() == 0


def test_one_source_and_silent_source(spark):
    params = ArbitrationParams(expected_sources=1, window_seconds=2, minimum_events=0, lag=5)
    copies = spark.createDataFrame(
        [("trade", "x", f"t:{i}", "only", i * 1_000_000, i) for i in range(8)], COPY_SCHEMA
    )
    sources = windows.roster(copies)
    gates = windows.gate_opening(sources, 1)
    credit = windows.credited(arbitrate.evictions(copies, params), gates, params)
    said = tally.verdicts(
        tally.window_wins(credit, sources, gates, params), [*GROUP, "window_no"], 0
    ).collect()
    assert {r.reason for r in said} == {"fewer than two sources contributed"}
    never = windows.gate_opening(sources, 2).first()
    assert never.open_us is None and never.open_offset is None
