"""Audit log decoding, removal planning and reconciliation on hand cases."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from feedarb.operators import audit, removal, rollups
from feedarb.params import RemovalParams

VERDICT = {
    "type": "verdict",
    "schema_version": 1,
    "stream_type": "trade",
    "symbol": "s",
    "window_start": 1.5,
    "window_end": 9.25,
    "slowest_source_id": "n",
    "counts": {"n": 1, "m": 2},
    "total_events": 3,
    "sources_seen": 2,
    "reason": None,
    "correlation_id": None,
}


def without(*names, **changes):
    return json.dumps({k: v for k, v in {**VERDICT, **changes}.items() if k not in names})


KILL = {"type": "kill_confirmed", "stream_type": "trade", "symbol": "s", "source_id": "n", "terminated_at": 12.0}
STALL = {
    "type": "gate_stalled",
    "stream_type": "trade",
    "symbol": "s",
    "sources_confirmed": 1,
    "sources_expected": 5,
    "stalled_for_seconds": 600.0,
    "ignored_sources": ["x"],
    "emitted_at": 3.0,
}

CASES = [
    (json.dumps(VERDICT), "ok"),
    (without("reason", "correlation_id"), "ok"),
    (without(slowest_source_id=None), "ok"),
    (without("slowest_source_id"), "malformed"),
    (without("schema_version"), "ok"),
    (without(schema_version=0), "ok"),
    (without(schema_version=True), "ok"),
    (without(schema_version=2), "unrecognised"),
    (without(schema_version=1.5), "unrecognised"),
    (without(schema_version="1"), "malformed"),
    (without(schema_version=None), "malformed"),
    (without("total_events", schema_version=2), "unrecognised"),
    (without(type="other"), "unrecognised"),
    (without(type=5), "unrecognised"),
    (without(type=None), "malformed"),
    (without("type"), "malformed"),
    (without("type", schema_version=2), "malformed"),
    (without(type=["verdict"]), "malformed"),
    (without(counts=None), "malformed"),
    (without(counts={}), "ok"),
    (without(extra={"a": [1]}), "ok"),
    ("[1]", "malformed"),
    ("null", "malformed"),
    ('"verdict"', "malformed"),
    ("{", "malformed"),
    ("", "malformed"),
    (json.dumps(VERDICT) + "x", "malformed"),
    (json.dumps(KILL), "ok"),
    (json.dumps({**KILL, "instance_id": "i-1"}), "ok"),
    (json.dumps({k: v for k, v in KILL.items() if k != "source_id"}), "malformed"),
    (json.dumps(STALL), "ok"),
    (json.dumps({**STALL, "ignored_sources": None}), "malformed"),
    (b"\xff{}", "malformed"),
    (None, "malformed"),
]


def with_last(body, **changes):
    """The same names once more at the end."""
    return body[:-1] + "," + json.dumps(changes)[1:]


TOLERANT = [
    (with_last(json.dumps(VERDICT), type="kill_confirmed"), "malformed"),
    (with_last(json.dumps({**VERDICT, "type": "other"}), type="verdict"), "ok"),
    (with_last(json.dumps(VERDICT), type="other"), "unrecognised"),
    (with_last(json.dumps(VERDICT), type=None), "malformed"),
    (with_last(json.dumps(VERDICT), schema_version=2), "unrecognised"),
    (with_last(without(schema_version="1"), schema_version=1), "ok"),
    (with_last(json.dumps(VERDICT), counts=None), "malformed"),
    (without(window_start=float("nan")), "ok"),
    (without(schema_version=float("nan")), "ok"),
    (without(schema_version=float("-inf")), "ok"),
    (without(schema_version=float("inf")), "unrecognised"),
    (without(schema_version="NaN"), "malformed"),
    (without(schema_version="Infinity"), "malformed"),
    (without(schema_version="true"), "malformed"),
    (without(schema_version=[1]), "malformed"),
    (without(type="[1]"), "unrecognised"),
    (without(type="{}"), "unrecognised"),
    (without(type={"a": 1}), "malformed"),
    (without(type="NaN"), "unrecognised"),
    (without(type=float("nan")), "unrecognised"),
    (without(counts="{}"), "malformed"),
    (json.dumps({**STALL, "ignored_sources": "[]"}), "malformed"),
    (json.dumps({**STALL, "ignored_sources": []}), "ok"),
    (json.dumps(VERDICT).replace('"', "'"), "malformed"),
    (json.dumps(VERDICT) + "," + json.dumps({"v": VERDICT})[1:-1], "malformed"),
    ('"{}"', "malformed"),
    (without(schema_version=1.0), "ok"),
    (json.dumps(VERDICT)[:-1] + ',"extra":NaN}', "ok"),
    (json.dumps(VERDICT)[:-1] + ',"extra":nan}', "malformed"),
]


def as_python_reads(body):
    """The rules on the parsed text: newer first, then unknown, then incomplete."""
    try:
        read = json.loads(body)
    except ValueError:
        return "malformed"
    if not isinstance(read, dict) or read.get("type") is None:
        return "malformed"
    version = read.get("schema_version", 1)
    if not isinstance(version, (int, float)):
        return "malformed"
    if version > 1:
        return "unrecognised"
    if isinstance(read["type"], (list, dict)):
        return "malformed"
    fields = audit.WIRE.get(read["type"])
    if fields is None:
        return "unrecognised"
    lacking = set(fields) - set(audit.OPTIONAL[read["type"]]) - set(read)
    wrong = "counts" in fields and not isinstance(read.get("counts"), dict)
    wrong |= "ignored_sources" in fields and not isinstance(read.get("ignored_sources"), list)
    return "malformed" if lacking or wrong else "ok"


def log(spark, bodies):
    rows = [(0, i, b.encode() if isinstance(b, str) else b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "partition int, offset bigint, value binary")


def test_log_messages_are_read_as_other_readers_do(spark):
    assert [as_python_reads(body) for body, _ in TOLERANT] == [status for _, status in TOLERANT]
    got = audit.decode(log(spark, [body for body, _ in TOLERANT])).orderBy("offset").collect()
    assert [r.decode_status for r in got] == [status for _, status in TOLERANT]


def test_last_of_repeated_members_and_untouched_strings(spark):
    counts = json.dumps(VERDICT).replace('{"n": 1, "m": 2}', '{"n": 1, "m": 2, "n": 7}')
    twice = with_last(json.dumps(VERDICT), slowest_source_id="z", window_end=4.5, reason='a NaN, {"b": -Infinity}')
    times = without(window_start=float("nan"), window_end=float("inf"))
    read = audit.decode(log(spark, [counts, twice, times])).orderBy("offset").collect()
    assert (read[0].counts, read[0].total_events) == ({"n": 7, "m": 2}, 3)
    assert (read[1].slowest_source_id, read[1].window_end, read[1].reason) == ("z", 4.5, 'a NaN, {"b": -Infinity}')
    assert math.isnan(read[2].window_start) and read[2].window_end == math.inf
    assert [r.is_actionable for r in read] == [True] * 3


def test_decode_status(spark):
    got = audit.decode(log(spark, [c[0] for c in CASES])).orderBy("offset").collect()
    assert [r.decode_status for r in got] == [c[1] for c in CASES]
    assert all(as_python_reads(b) == status for b, status in CASES if isinstance(b, str))
    first = got[0]
    assert (first.window_end, first.counts, first.is_actionable) == (9.25, {"n": 1, "m": 2}, True)
    assert got[2].is_actionable is False and got[3].is_actionable is None
    traffic = {
        r.message_type: r.messages
        for r in rollups.audit_traffic(audit.decode(log(spark, [c[0] for c in CASES]))).collect()
    }
    assert traffic["unknown"] == 5
    assert sum(traffic.values()) == len(CASES)


def test_round_trip(spark):
    decoded = audit.decode(log(spark, [json.dumps(VERDICT), json.dumps(KILL), json.dumps(STALL)]))
    for kind in ("verdict", "kill_confirmed", "gate_stalled"):
        typed = audit.of_type(decoded, kind)
        again = audit.encode(typed, kind, 3)
        row = again.first()
        assert (bytes(row.key).decode(), row.partition) == ("trade", 0)
        body = json.loads(bytes(row.value))
        assert body["type"] == kind and body["schema_version"] == 1
        assert list(body)[2:] == list(audit.WIRE[kind])
        redone = audit.decode(
            again.select("partition", F.lit(0).cast("bigint").alias("offset"), "value")
        )
        members = list(audit.WIRE[kind])
        assert audit.of_type(redone, kind).select(members).collect() == typed.select(members).collect()


def test_order_check(spark):
    bodies = [json.dumps(KILL), json.dumps(VERDICT), json.dumps(KILL)]
    got = audit.confirmations_before_verdict(audit.decode(log(spark, bodies))).collect()
    assert sorted((r.offset, r.preceded) for r in got) == [(0, False), (2, True)]


def nodes(spark):
    return spark.createDataFrame(
        [
            ("n", {"role": "listener"}, "aws:///z/i-0a", False),
            ("bare", {"x": "y"}, None, False),
            ("broker", {"role": "kafka"}, None, False),
            ("ip-10-0-0-1", {"role": "listener"}, None, False),
            ("ip-10-0-0-2.x", {"role": "listener"}, None, False),
            ("ip-10-0-0-3", {"role": "listener"}, None, False),
            ("odd", {"role": "listener"}, None, False),
        ],
        "name string, labels map<string,string>, provider_id string, unschedulable boolean",
    )


def instances(spark):
    return spark.createDataFrame(
        [
            ("i-1", "10.0.0.1", "running"),
            ("i-2", "10.0.0.2", "running"),
            ("i-3", "10.0.0.2", "running"),
            ("i-4", "10.0.0.3", "stopped"),
        ],
        "instance_id string, private_ip string, state string",
    )


NO_OUTCOMES = "stream_type string, symbol string, source_id string, verdict_offset bigint, ok boolean"


def plan_for(spark, params, names, handled=()):
    decoded = audit.decode(log(spark, [without(slowest_source_id=n) for n in names]))
    outcomes = spark.createDataFrame([("trade", "s", n, o, True) for n, o in handled], NO_OUTCOMES)
    actions = removal.verdict_actions(decoded, removal.handled_sources(outcomes))
    return removal.removal_plan(actions, nodes(spark), instances(spark), params)


def test_removal_plan(spark):
    names = ["n", "gone", "bare", "broker", "ip-10-0-0-1", "ip-10-0-0-2.x", "ip-10-0-0-3", "odd"]
    armed = RemovalParams(dry_run=False, terminate_enabled=True)
    got = {r.source_id: r for r in plan_for(spark, armed, names).collect()}
    assert {n: r.planned_action for n, r in got.items()} == {
        "n": "terminate",
        "gone": "refused:node_not_found",
        "bare": "refused:ineligible_label",
        "broker": "refused:ineligible_label",
        "ip-10-0-0-1": "terminate",
        "ip-10-0-0-2.x": "terminate",
        "ip-10-0-0-3": "terminate",
        "odd": "refused:unidentifiable_instance",
    }
    assert got["n"].instance_id == "i-0a" and got["ip-10-0-0-1"].instance_id == "i-1"
    assert got["ip-10-0-0-2.x"].identified_by == "ambiguous"
    assert got["ip-10-0-0-3"].identified_by == "not_found"
    assert got["broker"].label_problem == "node is role='kafka', not 'listener'"
    drained = RemovalParams(dry_run=False, terminate_enabled=False)
    assert {r.source_id: r.planned_action for r in plan_for(spark, drained, names).collect()}["odd"] == "cordon_drain"
    dry = plan_for(spark, RemovalParams(), names).collect()
    assert {r.planned_action for r in dry} == {"dry_run"} and len(dry) == len(names)


def test_repeats_are_suppressed_only_after_success(spark):
    armed = RemovalParams(dry_run=False, terminate_enabled=True)
    names = ["n", "n", "n", "odd", "odd"]
    got = plan_for(spark, armed, names, handled=[("n", 1)]).collect()
    assert sorted((r.source_id, r.offset) for r in got) == [("n", 0), ("n", 1), ("odd", 3), ("odd", 4)]


def test_action_reasons(spark):
    bodies = [
        json.dumps(VERDICT),
        without(slowest_source_id=None, reason="tie"),
        without(slowest_source_id=None, reason=None),
        without(schema_version=2),
        json.dumps(KILL),
        json.dumps(VERDICT),
        "broken",
    ]
    outcomes = spark.createDataFrame([("trade", "s", "n", 0, True)], NO_OUTCOMES)
    got = removal.verdict_actions(
        audit.decode(log(spark, bodies)), removal.handled_sources(outcomes)
    ).orderBy("offset").collect()
    assert [(r.act, r.action_reason) for r in got] == [
        (True, "n was slowest over 3 events from 2 sources"),
        (False, "verdict reached no conclusion: tie"),
        (False, "verdict reached no conclusion: no reason given"),
        (False, "unrecognised message type or schema version"),
        (False, "not a verdict (KillConfirmed)"),
        (False, "already acted on n for trade/s"),
    ]


@pytest.mark.parametrize("width", [1, 2, 1 << 20])
def test_confirmations_match_the_next_one(spark, width):
    bodies = [json.dumps(KILL), json.dumps(VERDICT), json.dumps(VERDICT), json.dumps(KILL), json.dumps(VERDICT)]
    matched = removal.match_confirmations(audit.decode(log(spark, bodies)), width)
    got = {r.offset: (r.confirmed_offset, r.confirmed_at) for r in matched.collect()}
    assert got == {1: (3, 12.0), 2: (3, 12.0), 4: (None, None)}


def test_confirmation_records(spark):
    armed = RemovalParams(dry_run=False, terminate_enabled=True)
    outcomes = spark.createDataFrame(
        [("trade", "s", "n", 0, True, "done", "i-0a", 77), ("trade", "s", "ip-10-0-0-3", 1, False, "terminate", None, None)],
        NO_OUTCOMES + ", stage string, instance_id string, terminated_us bigint",
    )
    plan = plan_for(spark, armed, ["n", "ip-10-0-0-3", "bare"])
    settled = removal.with_outcomes(plan, outcomes)
    (record,) = removal.confirmations(settled).collect()
    assert (record.source_id, record.instance_id, record.terminated_us) == ("n", "i-0a", 77)
    counters = {(r.counter, r.detail): r.value for r in rollups.removal_counters(plan, settled).collect()}
    assert counters == {
        ("attempted", None): 2,
        ("refused", "ineligible_label"): 1,
        ("succeeded", None): 1,
        ("failed", "terminate"): 1,
    }
    drained = plan_for(spark, RemovalParams(dry_run=False), ["n"])
    assert removal.confirmations(removal.with_outcomes(drained, outcomes)).count() == 0


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (44.0,), (1000.0,)], "w double")
    got = {r.le: r.n for r in rollups.duration_histogram(df, F.col("w")).collect()}
    assert len(got) == len(rollups.DURATION_BOUNDS)
    assert (got[1.0], got[30.0], got[45.0], got[180.0], got[float("inf")]) == (2, 2, 3, 3, 4)
