"""Operational counters, histograms and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.operators.arbitrate import KEY
from feedarb.operators.audit import WIRE
from feedarb.operators.removal import TYPE_NAMES, attempted
from feedarb.sources.landing import GROUP

# Upper bounds of the duration histogram, in seconds.
DURATION_BOUNDS = (1, 5, 10, 20, 30, 45, 60, 90, 120, 180, float("inf"))


def feed_counters(copies: DataFrame) -> DataFrame:
    """Copies consumed, forwarded, dropped as duplicates and ignored, per group.

    Input may carry an ``ignored`` flag.  Counts are formed per event first, so
    the classification itself is never materialised.
    """
    ignored = F.col("ignored") if "ignored" in copies.columns else F.lit(False)
    per_event = copies.groupBy(*KEY).agg(
        F.count("*").alias("_n"), F.count_if(ignored).alias("_ignored")
    )
    first = (F.col("_n") > F.col("_ignored")).cast("bigint")
    return per_event.groupBy(*GROUP).agg(
        F.sum("_n").alias("consumed"),
        F.sum(first).alias("forwarded"),
        F.sum(F.col("_n") - F.col("_ignored") - first).alias("duplicates"),
        F.sum("_ignored").alias("ignored"),
    )


def audit_traffic(decoded: DataFrame) -> DataFrame:
    """Log messages by type name, with ``unknown`` and ``malformed``."""
    shown = F.when(F.col("decode_status") == "malformed", "malformed").when(
        F.col("decode_status") == "unrecognised", "unknown"
    )
    for wire, name in TYPE_NAMES.items():
        shown = shown.when(F.col("message_type") == wire, name)
    return decoded.groupBy(shown.alias("message_type")).agg(F.count("*").alias("messages"))


def verdict_counts(decoded: DataFrame) -> DataFrame:
    """Verdicts per group, split by whether they named a source."""
    return (
        decoded.where(F.col("message_type") == "verdict")
        .groupBy(*GROUP, "is_actionable")
        .agg(F.count("*").alias("verdicts"))
    )


def audit_counts(decoded: DataFrame) -> DataFrame:
    """Good messages of each type per group."""
    return (
        decoded.where(F.col("message_type").isin(*WIRE))
        .groupBy(*GROUP, "message_type")
        .agg(F.count("*").alias("messages"))
    )


def removal_counters(plan: DataFrame, settled: DataFrame) -> DataFrame:
    """Long form (counter, detail, group, value) of what the removal plan led to."""
    action = F.col("planned_action")
    no_detail = F.lit(None).cast("string")
    refused_for = F.when(
        action.startswith("refused:"), F.substring_index(action, ":", -1)
    )
    planned = plan.select(
        F.when(action == "dry_run", "skipped_dry_run")
        .when(refused_for.isNotNull(), "refused")
        .otherwise("attempted")
        .alias("counter"),
        refused_for.alias("detail"),
        *GROUP,
    )
    ended = attempted(settled).where(F.col("ok").isNotNull()).select(
        F.when(F.col("ok"), "succeeded").otherwise("failed").alias("counter"),
        F.when(F.col("ok"), no_detail).otherwise(F.col("stage")).alias("detail"),
        *GROUP,
    )
    return (
        planned.unionByName(ended)
        .groupBy("counter", "detail", *GROUP)
        .agg(F.count("*").alias("value"))
    )


def duration_histogram(
    df: DataFrame, duration_seconds: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts per bound in one aggregation; the last bound is infinite."""
    counts = df.groupBy(*keys).agg(
        *[
            F.count_if(duration_seconds <= F.lit(float(bound))).alias(f"_{i}")
            for i, bound in enumerate(DURATION_BOUNDS)
        ]
    )
    buckets = F.array(
        *[
            F.struct(F.lit(float(b)).alias("le"), F.col(f"_{i}").alias("n"))
            for i, b in enumerate(DURATION_BOUNDS)
        ]
    )
    return counts.select(*keys, F.inline(buckets))


def last_removal(decoded: DataFrame) -> DataFrame:
    """Time of the last confirmed removal per group."""
    return (
        decoded.where(F.col("message_type") == "kill_confirmed")
        .groupBy(*GROUP)
        .agg(F.max("terminated_at").alias("last_removal_at"))
    )


def tumbling_leaderboard(firsts: DataFrame, length: str) -> DataFrame:
    """Wins and place of every source per group and clock-aligned window.

    ``firsts`` has one row per event: ``winner`` and ``arr_us``.  Works on a
    stream too, up to the place column.
    """
    wins = leaderboard_wins(firsts, F.timestamp_micros("arr_us"), length)
    best = W.partitionBy(*GROUP, "window_start_us").orderBy(F.desc("wins"))
    return wins.withColumn("place", F.rank().over(best))


def leaderboard_wins(firsts: DataFrame, arrived: Column, length: str) -> DataFrame:
    return (
        firsts.groupBy(*GROUP, F.window(arrived, length).alias("_w"), "winner")
        .agg(F.count("*").alias("wins"))
        .select(
            *GROUP,
            F.unix_micros("_w.start").alias("window_start_us"),
            F.col("winner").alias("source_id"),
            "wins",
        )
    )
