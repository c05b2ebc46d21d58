"""Keys, placement, identities, options and ingest checks."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from feedarb.functions import identity, keys
from feedarb.operators import ingest
from feedarb.params import ArbitrationParams, RemovalParams
from feedarb.sources.catalogue import stream_catalogue


def digest_slot(text: bytes, n: int) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "big") % n


def test_topic_partition_equals_hashlib(spark):
    pairs = [("Trade", "BTCUSDT"), ("depth", "ethusdt"), ("aggtrade", "sé"), ("x", "y" * 50)]
    df = spark.createDataFrame(pairs, "s string, m string")
    got = df.select("s", "m", keys.topic_partition(F.col("s"), F.col("m"), 6).alias("p")).collect()
    for row in got:
        material = f"{row.s.lower()}\0{row.m.lower()}".encode()
        assert row.p == digest_slot(material, 6)


def test_audit_partition(spark):
    df = spark.createDataFrame([("TRADE",), ("depth",), ("aggTrade",), ("Other",)], "s string")
    got = {
        r.s: (r.a, r.b)
        for r in df.select(
            "s",
            keys.audit_partition(F.col("s"), 3).alias("a"),
            keys.audit_partition(F.col("s"), 2).alias("b"),
        ).collect()
    }
    assert got["TRADE"] == (0, 0) and got["depth"] == (1, 1) and got["aggTrade"] == (2, 0)
    assert got["Other"] == (digest_slot(b"other", 3), digest_slot(b"other", 2))


@pytest.mark.parametrize("pair", [("", "x"), ("x", ""), (None, "x")])
def test_empty_parts_have_no_partition(spark, pair):
    df = spark.createDataFrame([pair], "s string, m string")
    with pytest.raises(Exception, match="must not be empty"):
        df.select(keys.topic_partition(F.col("s"), F.col("m"), 6)).collect()
    with pytest.raises(ValueError):
        keys.topic_partition(F.col("s"), F.col("m"), 0)


def test_message_keys(spark):
    df = spark.createDataFrame(
        [("t:1",), ("a:b:c",), (":1",), ("t:",), ("t",), ("",), (None,), ("t:x\ny",)], "k string"
    )
    key = F.col("k")
    got = [
        tuple(r)
        for r in df.select(
            keys.key_prefix(key), keys.key_event_id(key), keys.key_is_malformed(key)
        ).collect()
    ]
    bad = (None, None, True)
    assert got == [("t", "1", False), ("a", "b:c", False), bad, bad, bad, bad, bad, ("t", "x\ny", False)]
    built = spark.range(1).select(
        keys.message_key(F.lit("t"), F.lit(5)), keys.message_key(F.lit("t"), F.lit(None))
    )
    assert tuple(built.first()) == ("t:5", None)


def test_node_identity(spark):
    rows = [
        ("ip-172-31-39-170.ap-x", "aws:///zone/i-0ab", ("i-0ab", None)),
        ("ip-172-31-39-170.ap-x", None, (None, "172.31.39.170")),
        ("ip-172-031-001-10", "", (None, "172.31.1.10")),
        ("ip-172-31-999-1", None, (None, None)),
        ("ip-1-2-3-4x", None, (None, None)),
        ("x-ip-1-2-3-4", None, (None, None)),
        ("ip-1-2-3-4", "aws:///zone/i-XYZ", (None, "1.2.3.4")),
        (None, None, (None, None)),
    ]
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, n string, p string")
    got = df.select("i", identity.node_identity(F.col("p"), F.col("n")).alias("x")).orderBy("i").collect()
    assert [tuple(r.x) for r in got] == [r[2] for r in rows]


def test_raw_validation_order(spark):
    def headers(**values):
        return [{"key": k, "value": v} for k, v in values.items()]

    good = dict(stream_type=b"trade", symbol=b"s", source_id=b"a")
    cases = [
        (b"t:1", headers(**good), None),
        (None, headers(**good), "missing_key"),
        (b"", headers(**good), "missing_key"),
        (None, headers(**{**good, "symbol": b""}), "missing_header"),
        (b"t:1", None, "missing_header"),
        (b"t:1", headers(stream_type=b"trade", symbol=b"s"), "missing_header"),
        (b"t:1", [{"key": "symbol", "value": None}] + headers(**good), "missing_header"),
        (b"t:1", headers(**{**good, "symbol": b"\xff"}), "bad_encoding"),
        (b"\xff", headers(**good), "bad_encoding"),
        (b"\xff", headers(stream_type=b"trade"), "missing_header"),
    ]
    df = spark.createDataFrame(
        [(i, k, h) for i, (k, h, _) in enumerate(cases)],
        "i int, key binary, headers array<struct<key string, value binary>>",
    )
    got = ingest.validate_raw(df).orderBy("i").collect()
    assert [r.drop_reason for r in got] == [c[2] for c in cases]


def test_captured_lines(spark):
    lines = [
        ("Trade", '{"t": 12, "u": 3}', "t:12", None),
        ("depth", '{"t": 12, "u": "x:y"}', "d:x:y", None),
        ("aggtrade", '{"a": null}', None, "missing_id"),
        ("aggtrade", "{}", None, "missing_id"),
        ("trade", '{"t": 12', None, "bad_json"),
        ("trade", '{"t": 12} {"t": 13}', None, "bad_json"),
        ("trade", '{"t": 12}],[', None, "bad_json"),
        ("trade", '{"t": 12},"x":{"y":1}', None, "bad_json"),
        ("trade", '{"t": 12, "x": {"q": 1, "q": 2}}', "t:12", None),
        ("trade", '{"t": 12, "x": NaN}', "t:12", None),
        ("trade", '{"x": NaN, "t": "a NaN, b"}', "t:a NaN, b", None),
        ("trade", "{'t': 12}", None, "bad_json"),
        ("trade", "[12]", None, "bad_json"),
        ("trade", "", None, "bad_json"),
        ("trade", '{"x":{"t":1}}', None, "missing_id"),
        ("futures", '{"t": 1}', None, "unknown_stream"),
    ]
    df = spark.createDataFrame(
        [(i, s, "SYM", "src", line) for i, (s, line, _, _) in enumerate(lines)],
        "i int, stream_type string, symbol string, source_id string, line string",
    )
    shaped = ingest.shape_captured(df, stream_catalogue(spark))
    got = shaped.orderBy("i").collect()
    assert [(r.msg_key, r.drop_reason) for r in got] == [line[2:] for line in lines]
    assert {r.symbol for r in got} == {"sym"}
    sent = ingest.raw_messages(shaped, keys.topic_partition(F.col("stream_type"), F.col("symbol"), 6))
    assert ingest.validate_raw(sent).where("drop_reason is null").count() == 5
    assert bytes(sent.first().value).decode() == lines[0][1]
    more = stream_catalogue(spark, (("futures", "futures", "f", "t"),))
    assert ingest.shape_captured(df, more).where("msg_key = 'f:1'").count() == 1


def test_options():
    params = ArbitrationParams.from_options(
        {"expected_sources": "5", "window_seconds": "1200", "lag": "7", "lag.Depth": "9"}
    )
    assert (params.window_us, params.lag_for("depth"), params.lag_for("trade")) == (1_200_000_000, 9, 7)
    assert ArbitrationParams(expected_sources=1).lag == 1000
    for bad in (
        {},
        {"expected_sources": "0"},
        {"expected_sources": "x"},
        {"expected_sources": "1", "window_seconds": "0"},
        {"expected_sources": "1", "emit_tally_every": "0"},
        {"expected_sources": "1", "lag": "0"},
    ):
        with pytest.raises(ValueError):
            ArbitrationParams.from_options(bad)
    armed = RemovalParams.from_options({"dry_run": "Off", "terminate_enabled": "yes"})
    assert armed.armed and not RemovalParams(dry_run=True, terminate_enabled=True).armed
    with pytest.raises(ValueError):
        RemovalParams.from_options({"dry_run": "maybe"})
