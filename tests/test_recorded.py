"""Gate closures from namings, and removals of machines that are not found."""

from __future__ import annotations

from feedarb.operators import recorded, removal, windows
from feedarb.params import ArbitrationParams, RemovalParams

SECOND = 1_000_000


def closures(spark, arrivals, namings, expected):
    """``arrivals``: (source, second); ``namings``: the same."""
    feed = spark.createDataFrame(
        [("trade", "x", f"t:{i}", s, at * SECOND, i) for i, (s, at) in enumerate(sorted(arrivals, key=lambda a: a[1]))],
        "stream_type string, symbol string, msg_key string, source_id string, arr_us long, seq_offset long",
    )
    named = spark.createDataFrame(
        [("trade", "x", s, at * SECOND) for s, at in namings],
        "stream_type string, symbol string, slowest_source_id string, window_end_us long",
    )
    params = ArbitrationParams(expected_sources=expected, window_seconds=30)
    found = recorded.gate_closures(feed, windows.roster(feed), named, params).collect()
    return sorted((r.closed_us // SECOND, r.until_us // SECOND) for r in found)


def test_every_naming_closes_the_gate(spark):
    arrivals = [("a", 0), ("b", 1), ("c", 20), ("b", 35), ("c", 60), ("b", 95), ("c", 120)]
    assert closures(spark, arrivals, [("a", 30), ("a", 90)], 2) == [(0, 1), (30, 35), (90, 95)]
    # With one source too few the gate waits for another one.
    assert closures(spark, arrivals + [("d", 110)], [("a", 30), ("a", 90)], 3) == [(0, 20), (30, 110), (90, 110)]


def test_many_closings_in_one_group(spark):
    arrivals = [("ab"[i % 2], i) for i in range(12_000)]
    found = closures(spark, arrivals, [("gone", 2 * i + 1) for i in range(5_000)], 2)
    assert found == [(0, 1), *((2 * i + 1, 2 * i + 1) for i in range(5_000))]


def test_no_confirmation_without_a_machine(spark):
    plan = spark.createDataFrame(
        [("trade", "x", f"n{i}", i, 0, "terminate", by, instance, "c") for i, (by, instance) in enumerate(
            [("provider_id", "i-1"), ("address", "i-2"), ("ambiguous", None), ("not_found", None)])],
        "stream_type string, symbol string, source_id string, offset long, partition int, planned_action string,"
        " identified_by string, instance_id string, correlation_id string",
    )
    outcomes = spark.createDataFrame(
        [("trade", "x", f"n{i}", i, "done", True, "i-other", 5) for i in range(4)],
        "stream_type string, symbol string, source_id string, verdict_offset long, stage string, ok boolean,"
        " instance_id string, terminated_us long",
    )
    settled = removal.with_outcomes(plan, outcomes)
    assert {(r.source_id, r.ok, r.stage) for r in settled.collect()} == {
        ("n0", True, "done"), ("n1", True, "done"), ("n2", False, "terminate"), ("n3", False, "terminate")
    }
    assert {(r.source_id, r.instance_id) for r in removal.confirmations(settled).collect()} == {("n0", "i-1"), ("n1", "i-2")}
    assert not RemovalParams().armed


def test_next_copy_of_many_points_equals_a_plain_search(spark):
    """10,000 points and copies that leave slots empty, share instants and end before the last points."""
    import bisect
    import random

    from feedarb.operators.windows import SLOT_US, first_copy_after

    rng = random.Random(4)
    times = sorted(rng.choice([rng.randint(0, 400 * SLOT_US), rng.randint(0, 9) * 40 * SLOT_US]) for _ in range(1500))
    points = sorted({rng.randint(0, 410 * SLOT_US) for _ in range(9_000)} | set(times[:1000]))
    copies = spark.createDataFrame([("t", "x", o, us) for o, us in enumerate(times)], "stream_type string, symbol string, seq_offset bigint, arr_us bigint")
    asked = spark.createDataFrame([("t", g, us) for us in points for g in ("x", "y")], "stream_type string, symbol string, at_us bigint")
    got = {(r.symbol, r.at_us): (r.next_offset, r.next_us) for r in first_copy_after(copies, asked).collect()}
    assert len(got) == 2 * len(points)
    for us in points:
        at = bisect.bisect_left(times, us)
        assert got["x", us] == ((at, times[at]) if at < len(times) else (None, None))
        assert got["y", us] == (None, None)


def test_first_copies_are_found_without_a_sort(spark):
    from feedarb.operators.windows import first_copy_after
    from feedarb.plans import storage

    made = []
    real = storage.durable
    copies = spark.createDataFrame([("t", "a", 1, 5)], "stream_type string, symbol string, seq_offset long, arr_us long")
    from feedarb.operators import windows

    windows.durable = lambda df, label: (made.append(df), real(df, label))[1]
    try:
        found = first_copy_after(copies, copies.selectExpr("stream_type", "symbol", "arr_us as at_us"))
    finally:
        windows.durable = real
    assert [(r.next_offset, r.next_us) for r in found.collect()] == [(1, 5)]
    near = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(struct" not in near + "".join(df._jdf.queryExecution().executedPlan().toString() for df in made)
