"""The stateful operator and the live jobs on file streams."""

from __future__ import annotations

import json
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedarb.operators import arbitrate, audit, recorded
from feedarb.params import ArbitrationParams
from feedarb.plans.settings import OBSERVE
from feedarb.plans.storage import new_path
from feedarb.sources import derived, kafka
from feedarb.sources.landing import GROUP
from feedarb.streaming import feeds
from feedarb.streaming.processor import STATEFUL_SETTINGS
from tests.replay import place_confirmations, replay, state_snapshot, uncertain_groups
from tests.model import COPY_SCHEMA, as_rows, random_feed, simulate

PARAMS = ArbitrationParams(
    expected_sources=4, window_seconds=6, minimum_events=2, stall_warn_seconds=2, emit_tally_every=3, lag=8
)


@pytest.fixture(scope="module")
def live(spark):
    session = spark.newSession()
    for name, value in STATEFUL_SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def groups():
    return {("trade", "a"): random_feed(1, 70), ("depth", "b"): random_feed(2, 70, repeat=0.4)}


def feed_frame(spark):
    rows = [r for (s, m), feed in groups().items() for r in as_rows(feed, s, m)]
    return spark.createDataFrame(rows, COPY_SCHEMA)


def check_against_model(messages, confirmations=()):
    rows = messages.collect()
    for group, feed in groups().items():
        run = simulate(feed, PARAMS, PARAMS.lag, confirmations=confirmations)
        mine = [r for r in rows if (r.stream_type, r.symbol) == group]
        assert sorted(r.seq_offset for r in mine if r.kind == "forwarded") == run.forwarded
        assert sorted(
            (r.window_start_us, r.at_us, r.slowest_source_id, r.counts, r.total_events, r.reason)
            for r in mine
            if r.kind == "verdict"
        ) == sorted(run.verdicts, key=lambda v: v[:2])
        assert sorted((r.at_us, r.total_events) for r in mine if r.kind == "tally") == sorted(
            (t[0], t[3]) for t in run.tallies
        )
        assert sorted(
            (r.at_us, r.sources_confirmed, r.stalled_for_us, tuple(r.ignored_sources))
            for r in mine
            if r.kind == "gate_stalled"
        ) == sorted(run.stalls)


@pytest.mark.parametrize("slice_offsets", [1_000_000, 90])
def test_replay_equals_model_however_it_is_sliced(spark, slice_offsets):
    copies = feed_frame(spark)
    confirmed = spark.createDataFrame(
        [(s, m, "s1", 17_300_000) for s, m in groups()],
        "stream_type string, symbol string, source_id string, terminated_us bigint",
    )
    messages = replay(copies, PARAMS, confirmed, slice_offsets)
    check_against_model(messages, [(17_300_000, "s1")])
    for row in state_snapshot(messages).collect():
        feed = groups()[(row.stream_type, row.symbol)]
        run = simulate(feed, PARAMS, PARAMS.lag, confirmations=[(17_300_000, "s1")])
        assert row.pending == len(run.cached) and row.consumed == len(feed)
        assert row.forwarded + row.duplicates + row.ignored == len(feed)


def test_confirmations_are_placed_at_the_next_copy(spark):
    copies = spark.createDataFrame(
        [("t", "x", "k", "s", at, i) for i, at in enumerate((10, 20, 20, 50))], COPY_SCHEMA
    )
    times = [5, 10, 11, 20, 21, 30, 51]
    confirmed = spark.createDataFrame(
        [("t", "x", "s", t) for t in times],
        "stream_type string, symbol string, source_id string, terminated_us bigint",
    )
    got = {r.terminated_us: r.seq_offset for r in place_confirmations(copies, confirmed).collect()}
    assert got == {5: 0, 10: 0, 11: 1, 20: 1, 21: 3, 30: 3}


def test_closed_loop_on_the_derived_feed(spark):
    """Totals of the closed loop; every published verdict is recomputed from the copies."""
    copies = derived.copies(spark, "/root/testdata/sf0.01", redelivery=False).drop("value")
    messages = replay(copies, OBSERVE)
    said = messages.where("kind = 'verdict'").withColumnRenamed("at_us", "window_end_us")
    checked = recorded.recheck_verdicts(copies, said, None, OBSERVE, width=512)
    filtered = arbitrate.drop_ignored(copies, recorded.ignored_from(said))
    certain = arbitrate.certificate(arbitrate.evictions(filtered, OBSERVE))
    exact = checked.join(certain.where("readmitted_keys = 0"), [*GROUP], "left_semi")
    assert exact.count() > 0
    assert exact.where(~F.col("matched")).count() == 0


def test_uncertain_groups(spark):
    copies = feed_frame(spark)
    certificate = arbitrate.certificate(arbitrate.evictions(copies, PARAMS))
    kept = {tuple(r) for r in uncertain_groups(copies, certificate).select(*GROUP).distinct().collect()}
    assert kept == {(r.stream_type, r.symbol) for r in certificate.where("readmitted_keys > 0").collect()}


def raw_frame(session, rows):
    """Broker-shaped messages of (stream, symbol, key, source, us, offset)."""
    header = lambda name: F.struct(F.lit(name).alias("key"), F.col(name).cast("binary").alias("value"))
    return session.createDataFrame(rows, COPY_SCHEMA).select(
        F.col("msg_key").cast("binary").alias("key"),
        F.concat(F.lit("payload "), "msg_key").cast("binary").alias("value"),
        F.array(header("source_id"), header("stream_type"), header("symbol"), header("msg_key")).alias("headers"),
        F.lit("market-data-raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq_offset").alias("offset"),
        F.timestamp_micros("arr_us").alias("timestamp"),
    )


def test_arbiter_restarts_and_writes_both_outputs(live):
    rows = [r for (s, m), feed in groups().items() for r in as_rows(feed, s, m)]
    rows.sort(key=lambda r: r[4])
    inbox, feed_out, audit_out, checkpoint = (new_path(live, n) for n in ("in", "feed", "audit", "cp"))
    third = len(rows) // 3 + 1
    # Offsets decide the order inside a micro-batch, so each part is written shuffled.
    for start in range(0, len(rows), third):
        part = raw_frame(live, rows[start : start + third]).orderBy(F.rand(3))
        part.write.mode("append").parquet(inbox)
        raw = live.readStream.schema(part.schema).parquet(inbox)
        messages = feeds.arbitration_stream(raw, None, PARAMS, live=False)
        feeds.run_arbiter(
            messages,
            lambda df, n: df.write.mode("append").parquet(feed_out),
            lambda df, n: df.write.mode("append").parquet(audit_out),
            3,
            checkpoint,
        ).trigger(availableNow=True).start().awaitTermination()
    forwarded = live.read.parquet(feed_out)
    decoded = audit.decode(
        live.read.parquet(audit_out).withColumn("offset", F.lit(0).cast("bigint"))
    )
    assert decoded.where("decode_status <> 'ok'").count() == 0
    verdicts = audit.of_type(decoded, "verdict").collect()
    for group, feed in groups().items():
        run = simulate(feed, PARAMS, PARAMS.lag)
        mine = forwarded.where((F.col("stream_type") == group[0]) & (F.col("symbol") == group[1]))
        assert sorted(r.seq_offset for r in mine.collect()) == run.forwarded
        assert sorted(
            (round(r.window_end * 1e6), r.slowest_source_id, r.counts)
            for r in verdicts
            if (r.stream_type, r.symbol) == group
        ) == sorted(((v[1], v[2], v[3]) for v in run.verdicts), key=lambda v: v[0])
    row = kafka.arbitrated_rows(forwarded, 6).first()
    assert bytes(row.value) == b"payload " + bytes(row.key)
    assert [h.key for h in row.headers] == ["source_id", "stream_type", "symbol", "msg_key"]
    assert bytes(row.headers[3].value) == bytes(row.key)


def test_live_timers_close_windows_without_traffic(live):
    params = ArbitrationParams(
        expected_sources=2, window_seconds=1, minimum_events=1, stall_warn_seconds=2, lag=5
    )
    now = int(time.time() * 1_000_000)
    rows = [
        ("trade", "x", f"t:{i}", source, now + i, 2 * i + j)
        for i in range(4)
        for j, source in enumerate(("a", "b"))
    ]
    inbox, results = new_path(live, "in"), new_path(live, "out")
    part = raw_frame(live, rows)
    part.write.parquet(inbox)
    raw = live.readStream.schema(part.schema).parquet(inbox)
    query = (
        feeds.arbitration_stream(raw, None, params)
        .writeStream.format("parquet")
        .option("path", results)
        .option("checkpointLocation", new_path(live, "cp"))
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 60
        kinds: dict[str, int] = {}
        while time.time() < deadline and not {"verdict", "gate_stalled"} <= set(kinds):
            time.sleep(1)
            if query.exception() is not None:
                raise query.exception()
            try:
                said = live.read.parquet(results)
                kinds = {r["kind"]: r["count"] for r in said.groupBy("kind").count().collect()}
            except Exception:  # nothing written yet
                continue
    finally:
        query.stop()
    verdict = live.read.parquet(results).where("kind = 'verdict'").first()
    assert verdict.slowest_source_id == "b" and verdict.counts == {"a": 4, "b": 0}
    assert verdict.at_us % 1_000_000 == 0
    assert kinds["gate_stalled"] >= 1


def test_plain_feed_drops_repeats(live):
    inbox = new_path(live, "in")
    copies = live.createDataFrame(as_rows(random_feed(3, 40)), COPY_SCHEMA)
    copies.write.parquet(inbox)
    stream = live.readStream.schema(copies.schema).parquet(inbox)
    query = (
        feeds.plain_feed(stream, "10 minutes")
        .writeStream.format("memory")
        .queryName("plain")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = live.table("plain")
    assert got.count() == copies.select("msg_key").distinct().count()
    assert got.select("msg_key").distinct().count() == got.count()


def test_await_confirmations_and_leaderboard(live):
    inbox = new_path(live, "in")
    verdict = {
        "type": "verdict", "stream_type": "trade", "symbol": "s", "window_start": 0.0, "counts": {},
        "total_events": 1, "sources_seen": 2,
    }
    kill = {"type": "kill_confirmed", "stream_type": "trade", "symbol": "s"}
    bodies = [
        {**verdict, "slowest_source_id": "a", "window_end": 1000.0},
        {**verdict, "slowest_source_id": "b", "window_end": 1001.0},
        {**kill, "source_id": "a", "terminated_at": 1030.0},
    ]
    # Later traffic moves the watermark past the waiting verdict.
    later = [
        {**verdict, "slowest_source_id": "z", "window_end": 90_000.0},
        {**kill, "source_id": "y", "terminated_at": 90_000.0},
    ]
    checkpoint, results = new_path(live, "cp"), new_path(live, "out")
    for part in (bodies, later):
        rows = [(0, i, json.dumps(b).encode()) for i, b in enumerate(part)]
        df = live.createDataFrame(rows, "partition int, offset bigint, value binary")
        df.write.mode("append").parquet(inbox)
        decoded = audit.decode(live.readStream.schema(df.schema).parquet(inbox))
        feeds.await_confirmations(decoded, "10 minutes").writeStream.format("parquet").option(
            "path", results
        ).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = {r.source_id: r.confirmed_at for r in live.read.parquet(results).collect()}
    assert got["a"].timestamp() == 1030.0 and got["b"] is None and "z" not in got

    forwarded = live.createDataFrame(
        [("t", "x", "a", 5_000_000), ("t", "x", "a", 6_000_000), ("t", "x", "b", 61_000_000)],
        "stream_type string, symbol string, source_id string, arr_us bigint",
    )
    standing = feeds.live_leaderboard(forwarded, "1 minute", "1 minute").collect()
    assert {(r.window_start_us, r.source_id, r.wins) for r in standing} == {
        (0, "a", 2), (60_000_000, "b", 1),
    }


def test_kafka_options(live):
    options = kafka.source_options("h:9092", kafka.RAW_TOPIC, max_offsets=10)
    assert options["startingOffsets"] == "earliest" and options["includeHeaders"] == "true"
    assert options["maxOffsetsPerTrigger"] == "10"
    assert kafka.source_options("h", "t", "latest")["startingOffsets"] == "latest"
    assert kafka.sink_options("h", "t")["kafka.acks"] == "all"
    with pytest.raises(ValueError):
        kafka.source_options("h", "t", "middle")


def test_stateful_operator_runs_from_any_folder(tmp_path):
    """Workers get the package from the application, not from a working directory."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "job.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(root)!r})\n"
        "from tests.conftest import make_session\n"
        "from feedarb.plans.settings import OBSERVE\n"
        "from feedarb.sources import derived\n"
        "from tests.replay import replay, state_snapshot\n"
        "spark = make_session()\n"
        "feed = derived.copies(spark, '/root/testdata/sf0.001').drop('value')\n"
        "print('groups', state_snapshot(replay(feed, OBSERVE)).count())\n"
    )
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "groups 9" in done.stdout, done.stderr[-2000:]
