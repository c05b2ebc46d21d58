"""Presence as runs and stall warnings as a sweep, against plain Python."""

from __future__ import annotations

import random

import pytest

from feedarb.operators import tally, windows
from feedarb.params import ArbitrationParams

SECOND = 1_000_000
GROUP = ["stream_type", "symbol"]


@pytest.mark.parametrize("minimum", [0, 3])
def test_verdicts_and_wins_by_runs_equal_the_long_form(spark, minimum):
    params = ArbitrationParams(expected_sources=2, window_seconds=3, minimum_events=minimum, lag=5)
    draw = random.Random(minimum)
    sources, gates, credit = [], [], []
    for symbol in "abcd":
        last = draw.randint(20, 90) * SECOND
        firsts = sorted(draw.randrange(last) for _ in range(draw.randint(2, 7)))
        opened = firsts[1]
        own = [(f"m{draw.randrange(100):02}-{i}", first) for i, first in enumerate(firsts)]
        sources += [("t", symbol, name, i * 10, first, last) for i, (name, first) in enumerate(own)]
        gates.append(("t", symbol, firsts[0], 10, opened, last))
        for at in range(400):
            instant = draw.randrange(opened, last)
            there = [name for name, first in own if first <= instant]
            credit.append(("t", symbol, draw.choice(there[: draw.randint(1, len(there))]), at, instant))
    sources = spark.createDataFrame(sources, "stream_type string, symbol string, source_id string, first_offset long, first_us long, last_us long")
    gates = spark.createDataFrame(gates, "stream_type string, symbol string, started_us long, open_offset long, open_us long, last_us long")
    frame = spark.createDataFrame(credit, "stream_type string, symbol string, winner string, evict_offset long, at_us long")
    closed = windows.closed_windows(params)
    credit = (
        frame.join(gates, GROUP)
        .withColumn("window_no", windows.window_number(frame["at_us"], params))
        .withColumn("window_closed", windows.window_number(frame["at_us"], params) < closed)
        .select(*GROUP, "winner", "evict_offset", "window_no", "window_closed")
    )
    if minimum == 0:  # windows without any win as well
        credit = credit.where("window_no % 4 <> 1")
    long_form = tally.window_wins(credit, sources, gates, params).collect()
    want = tally.verdicts(tally.window_wins(credit, sources, gates, params), [*GROUP, "window_no"], minimum)
    got = tally.verdicts_by_runs(credit, sources, gates, params).select(*want.columns)
    wanted = {tuple(r) for r in want.collect()}
    assert {tuple(r) for r in got.collect()} == wanted
    assert {r[3] is None for r in wanted} == {True, False}
    runs = tally.win_runs(credit, sources, gates, params).collect()
    spelled = [(r.symbol, r.source_id, w, r.wins) for r in runs for w in range(r.from_window, r.to_window + 1)]
    assert sorted(spelled) == sorted((r.symbol, r.source_id, r.window_no, r.wins) for r in long_form)
    assert len(runs) < len(long_form)


def test_runs_do_not_grow_with_windows(spark):
    """10,000 machines over 100,000 windows in which two of them win: no row per machine and window."""
    params = ArbitrationParams(expected_sources=2, window_seconds=1, minimum_events=0, lag=5)
    last = 100_000 * SECOND
    sources = spark.range(10_000).selectExpr(
        "'t' stream_type", "'s' symbol", "concat('m', id) source_id", "id first_offset", "id first_us", f"{last}L last_us"
    )
    gates = windows.gate_opening(sources, 2)
    credit = spark.createDataFrame(
        [("t", "s", "m3", 7, True), ("t", "s", "m3", 9, True), ("t", "s", "m5", 9, True)],
        "stream_type string, symbol string, winner string, window_no long, window_closed boolean",
    )
    runs = tally.win_runs(credit, sources, gates, params)
    assert runs.count() == 10_000 + 3 + 2 + 1
    told = tally.verdicts_by_runs(credit, sources, gates, params)
    assert told.where("slowest_source_id is not null").count() == 0
    assert told.where("sources_seen = 10000").count() == told.count() > 99_000


def test_stall_warnings_with_many_closings_and_machines(spark):
    params = ArbitrationParams(expected_sources=50, window_seconds=10, minimum_events=0, lag=5, stall_warn_seconds=30)
    draw = random.Random(4)
    day = 86_400 * SECOND
    closures, sightings, ignored = [], [], []
    for group in range(4):
        at = 0
        for _ in range(2_500):
            closed = at + draw.randrange(1, 20 * SECOND)
            at = closed + draw.randrange(1, 90 * SECOND)
            closures.append(("t", f"g{group}", closed, at))
        for machine in range(2_500):
            first = draw.randrange(2 * day)
            sightings.append(("t", f"g{group}", f"m{machine}", first))
            if machine % 500 == 0:
                ignored.append(("t", f"g{group}", f"m{machine}", first + draw.choice((0, 1, 5, day))))
        ignored.append(("t", f"g{group}", "never seen", draw.randrange(day)))
    found = windows.stall_warnings(
        spark.createDataFrame(closures, "stream_type string, symbol string, closed_us long, until_us long"),
        spark.createDataFrame(sightings, "stream_type string, symbol string, source_id string, first_us long"),
        spark.createDataFrame(ignored, "stream_type string, symbol string, source_id string, from_us long"),
        params,
    ).collect()
    assert len({(r.symbol, r.closed_us) for r in found}) > 4_000
    first_seen = {g: [(m, f) for _, h, m, f in sightings if h == g] for g in {r.symbol for r in found}}
    gone_from = {g: {m: f for _, h, m, f in ignored if h == g} for g in first_seen}
    for r in draw.sample(found, 400):
        gone = {m for m, at in gone_from[r.symbol].items() if at <= r.emitted_us}
        here = sum(first < r.emitted_us and m not in gone for m, first in first_seen[r.symbol])
        assert (r.sources_confirmed, r.ignored_sources) == (here, sorted(gone))
        assert r.stalled_for_us == r.emitted_us - r.closed_us
