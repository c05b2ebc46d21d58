"""Windows, verdicts and removals in batch against the literal model."""

from __future__ import annotations

import random

import pytest

from feedarb.operators import closed_loop
from feedarb.params import ArbitrationParams
from tests.model import COPY_SCHEMA, as_rows, simulate

CONFIRMED = "stream_type string, symbol string, source_id string, terminated_us bigint"


def fleet_feed(seed, events=260, sources=9, live=4):
    """One group in which machines come and go: (offset, us, key, source)."""
    rng = random.Random(seed)
    delivered = []
    for event in range(events):
        at = 3_000_000 + event * rng.randint(150_000, 260_000)
        first = event * (sources - live) // events
        for source in range(first, first + live + 1):
            if rng.random() < 0.85:
                us = at + rng.randint(0, 900_000) + 40_000 * (source % 4)
                if rng.random() < 0.05:
                    us = us // 1_000_000 * 1_000_000  # at the instant of a tick
                delivered.append((us, event, source))
                if rng.random() < 0.1:
                    delivered.append((us + rng.randint(1, 9_000_000), event, source))
    delivered.sort()
    return [(o, us, f"t:{event}", f"s{source}") for o, (us, event, source) in enumerate(delivered)]


def check(spark, feeds, params, confirmations, width):
    rows = [r for (stream, symbol), feed in feeds.items() for r in as_rows(feed, stream, symbol)]
    told = [(*group, source, us) for group, some in confirmations.items() for us, source in some]
    got = closed_loop.closed_loop(
        spark.createDataFrame(rows, COPY_SCHEMA), params, spark.createDataFrame(told, CONFIRMED) if told else None, width
    )
    counts = {}
    for r in got.wins.collect():
        counts.setdefault((r.stream_type, r.symbol, r.window_start_us, r.window_end_us), {})[r.source_id] = r.wins
    verdicts = got.verdicts.collect()
    assert len(counts) == len(verdicts)
    ignored = {(r.stream_type, r.symbol, r.source_id) for r in got.ignored.collect()}
    named = 0
    for group, feed in feeds.items():
        run = simulate(feed, params, params.lag_for(group[0]), confirmations=confirmations.get(group, ()))
        mine = sorted(
            (r.window_start_us, r.window_end_us, r.slowest_source_id, counts[(*group, r.window_start_us, r.window_end_us)], r.total_events, r.reason)
            for r in verdicts
            if (r.stream_type, r.symbol) == group
        )
        assert mine == sorted(run.verdicts, key=lambda v: v[:2])
        named += sum(v[2] is not None for v in run.verdicts)
        removed = {v[2] for v in run.verdicts if v[2]} | {s for us, s in confirmations.get(group, ()) if us > feed[0][1]}
        assert {s for *g, s in ignored if tuple(g) == group} == removed
    return named


@pytest.mark.parametrize("seed,lag,minimum,width", [(0, 30, 12, 1 << 17), (10, 8, 5, 500)])
def test_equals_model(spark, seed, lag, minimum, width):
    params = ArbitrationParams(expected_sources=4, window_seconds=5, minimum_events=minimum, lag=lag, lag_by_stream={"depth": 9})
    feeds = {(("trade", "depth")[n % 2], f"sym{n}"): fleet_feed(seed + n, 160) for n in range(3)}
    assert check(spark, feeds, params, {}, width) > 2


def test_confirmations_equal_model(spark):
    params = ArbitrationParams(expected_sources=4, window_seconds=4.5, minimum_events=4, lag=25)
    feeds = {("trade", f"sym{n}"): fleet_feed(40 + n, 160) for n in range(3)}
    confirmations = {}
    for n, (group, feed) in enumerate(feeds.items()):
        rng = random.Random(n)
        own = [(rng.choice(feed)[1] + rng.choice([0, 0, -1, 500]), f"s{rng.randint(0, 8)}") for _ in range(4)]
        own += [(feed[0][1], "s1"), (feed[len(feed) // 3][1] // 1_000_000 * 1_000_000, "s2"), (feed[-1][1] + 9_000_000, "s8")]
        confirmations[group] = sorted(own)
    assert check(spark, feeds, params, confirmations, 500) > 0


def test_a_fleet_that_stays_large_enough_reopens_with_the_next_copy(spark):
    params = ArbitrationParams(expected_sources=2, window_seconds=3, minimum_events=1, lag=50)
    feeds = {("trade", "a"): fleet_feed(7, 120, live=5), ("trade", "b"): [(0, 5_000_000, "t:1", "s0")]}
    assert check(spark, feeds, params, {("trade", "b"): [(9_000_000, "s0")]}, 1 << 17) > 1
