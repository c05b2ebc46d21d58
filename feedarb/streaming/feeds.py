"""Live jobs: the arbiter with its two outputs, the plain feed, confirmations, standings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedarb.operators import audit
from feedarb.operators.ingest import validate_raw
from feedarb.operators.rollups import leaderboard_wins
from feedarb.params import ArbitrationParams
from feedarb.sources.landing import GROUP
from feedarb.streaming.processor import arbitrate, tag_confirmations, tag_copies

_HEADERS = "array<struct<key string, value binary>>"


def live_copies(raw: DataFrame) -> DataFrame:
    """Good broker messages of a raw stream, headers kept for the arbitrated feed."""
    return (
        validate_raw(raw)
        .where(F.col("drop_reason").isNull())
        .select(
            *GROUP,
            "msg_key",
            "source_id",
            F.col("offset").alias("seq_offset"),
            F.unix_micros("timestamp").alias("arr_us"),
            "value",
            "headers",
        )
    )


def live_confirmations(log: DataFrame) -> DataFrame:
    """Removal confirmations out of an audit stream; everything else is passed over."""
    confirmed = audit.of_type(audit.decode(log), "kill_confirmed")
    return confirmed.select(
        *GROUP,
        "source_id",
        (F.col("terminated_at") * 1_000_000).cast("bigint").alias("terminated_us"),
    )


def arbitration_stream(
    raw: DataFrame, log: DataFrame | None, params: ArbitrationParams, live: bool = True
) -> DataFrame:
    """Both inputs of the state machine as one keyed stream."""
    tagged = tag_copies(live_copies(raw))
    if log is not None:
        tagged = tagged.unionByName(tag_confirmations(live_confirmations(log)))
    return arbitrate(tagged, params, live)


def forwarded_copies(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("kind") == "forwarded").select(
        *GROUP,
        "msg_key",
        "source_id",
        "seq_offset",
        F.col("at_us").alias("arr_us"),
        "value",
        F.from_json("headers", _HEADERS).alias("headers"),
    )


def audit_messages(messages: DataFrame) -> dict[str, DataFrame]:
    """The three kinds of messages the arbiter writes, with their wire members."""
    start, at = (audit.wire_seconds(F.col(c)) for c in ("window_start_us", "at_us"))
    stalled_for = audit.wire_seconds(F.col("stalled_for_us"))
    return {
        "tally": messages.where(F.col("kind") == "tally").withColumns(
            {"window_start": start, "emitted_at": at}
        ),
        "verdict": messages.where(F.col("kind") == "verdict").withColumns(
            {"window_start": start, "window_end": at}
        ),
        "gate_stalled": messages.where(F.col("kind") == "gate_stalled").withColumns(
            {"stalled_for_seconds": stalled_for, "emitted_at": at}
        ),
    }


def run_arbiter(
    messages: DataFrame,
    write_feed: Callable[[DataFrame, int], None],
    write_audit: Callable[[DataFrame, int], None],
    audit_partitions: int,
    checkpoint: str,
) -> DataStreamWriter:
    """One stateful query, two outputs per micro-batch: arbitrated feed and audit log.

    The writers get the rows and the batch number and may see a batch again after
    a failure.
    """

    def both(batch: DataFrame, number: int) -> None:
        batch.persist()
        write_feed(forwarded_copies(batch), number)
        write_audit(audit.encode_all(audit_messages(batch), audit_partitions), number)
        batch.unpersist()

    return messages.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)


def plain_feed(copies: DataFrame, late_by: str) -> DataFrame:
    """Each event once, without ranking: a copy repeated within ``late_by`` is dropped.

    Which of the copies in a micro-batch survives is not said, so take no winners
    from here.
    """
    return (
        copies.withColumn("arrived", F.timestamp_micros("arr_us"))
        .withWatermark("arrived", late_by)
        .dropDuplicatesWithinWatermark([*GROUP, "msg_key"])
    )


def await_confirmations(log: DataFrame, patience: str) -> DataFrame:
    """Naming verdicts with their confirmation, or without one after ``patience``.

    ``log`` is a decoded audit stream.
    """
    named = (
        log.where(F.coalesce("is_actionable", F.lit(False)))
        .select(
            *GROUP,
            F.col("slowest_source_id").alias("source_id"),
            F.timestamp_seconds("window_end").alias("named_at"),
        )
        .withWatermark("named_at", patience)
    )
    confirmed = (
        log.where(F.col("message_type") == "kill_confirmed")
        .select(
            F.col("stream_type").alias("_stream"),
            F.col("symbol").alias("_symbol"),
            F.col("source_id").alias("_source"),
            F.timestamp_seconds("terminated_at").alias("confirmed_at"),
        )
        .withWatermark("confirmed_at", patience)
    )
    matching = (
        (F.col("stream_type") == F.col("_stream"))
        & (F.col("symbol") == F.col("_symbol"))
        & (F.col("source_id") == F.col("_source"))
        & (F.col("confirmed_at") >= F.col("named_at"))
        & (F.col("confirmed_at") <= F.col("named_at") + F.expr(f"interval {patience}"))
    )
    return named.join(confirmed, matching, "left").drop("_stream", "_symbol", "_source")


def live_leaderboard(forwarded: DataFrame, length: str, late_by: str) -> DataFrame:
    """Wins per source and clock-aligned window over the arbitrated feed."""
    arrived = forwarded.select(
        *GROUP,
        F.col("source_id").alias("winner"),
        F.timestamp_micros("arr_us").alias("arrived"),
    ).withWatermark("arrived", late_by)
    return leaderboard_wins(arrived, F.col("arrived"), length)
