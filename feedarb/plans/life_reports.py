"""Reports on every life of every event, where the cache's history counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedarb.operators import arbitrate, closed_loop, ingest, lives, recorded
from feedarb.plans.reports import topic_rows, retired_sources
from feedarb.plans.settings import OBSERVE
from feedarb.plans.storage import durable
from feedarb.sources import derived
from feedarb.sources.landing import GROUP

KEY = arbitrate.KEY


#: What was walked through once is read from then on, per application and state of the input.
_known: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, derived.input_state(spark, sf_dir, "events"), name)
    if key not in _known:
        _known[key] = make()
    return _known[key]


def _without_ignored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, lives.Lives]:
    feed = derived.copies(spark, sf_dir)
    return feed, _once(spark, sf_dir, "lives", lambda: lives.lives(feed, OBSERVE))


def _with_ignored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, lives.Lives]:
    """The feed, and its lives with recorded removals left out from their time on."""
    feed = derived.copies(spark, sf_dir)
    gone = recorded.ignored_from(retired_sources(spark, sf_dir))
    return feed, _once(spark, sf_dir, "kept lives", lambda: lives.lives(feed, OBSERVE, gone))


def forwarded_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies that are forwarded: the first of each life."""
    feed, found = _without_ignored(spark, sf_dir)
    return lives.forwarded(feed, found).select(*KEY, "source_id", "seq_offset", "arr_us", "value")


def copy_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, found = _with_ignored(spark, sf_dir)
    return lives.outcomes(feed, found).select(*KEY, "source_id", "seq_offset", "outcome")


def evictions_all_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lives.evictions(_without_ignored(spark, sf_dir)[1]).drop("first_us")


def pending_all_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lives.pending_entries(*_without_ignored(spark, sf_dir))


def feed_counters_all_lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lives.feed_counters(*_with_ignored(spark, sf_dir))


def forwarded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good broker messages that are forwarded, as rows of the arbitrated topic."""
    good = (
        ingest.validate_raw(derived.raw_copies(spark, sf_dir))
        .where("drop_reason is null")
        .withColumns({"seq_offset": F.col("offset"), "arr_us": F.unix_micros("timestamp")})
    )
    return topic_rows(lives.forwarded(good, lives.lives(good, OBSERVE)))


def _loop(spark: SparkSession, sf_dir: str) -> closed_loop.ClosedLoop:
    def run() -> closed_loop.ClosedLoop:
        confirmed = durable(derived.confirmed_removals(spark, sf_dir), "confirmed")
        return closed_loop.closed_loop(derived.copies(spark, sf_dir), OBSERVE, confirmed)

    return _once(spark, sf_dir, "closed loop", run)


def closed_loop_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a system that leaves named and confirmed sources out from then on."""
    return _loop(spark, sf_dir).verdicts


def closed_loop_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loop(spark, sf_dir).wins


def closed_loop_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the gate was closed: from the cold start and from every naming until it opened."""
    return _loop(spark, sf_dir).closures


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "forwarded_feed": forwarded_feed,
        "copy_outcomes": copy_outcomes,
        "evictions_all_lives": evictions_all_lives,
        "pending_all_lives": pending_all_lives,
        "feed_counters_all_lives": feed_counters_all_lives,
        "forwarded_rows": forwarded_rows,
        "closed_loop_verdicts": closed_loop_verdicts,
        "closed_loop_wins": closed_loop_wins,
        "closed_loop_closures": closed_loop_closures,
    }
