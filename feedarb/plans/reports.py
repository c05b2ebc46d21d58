"""The registered reports: operators applied to the feeds derived from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedarb.functions import keys
from feedarb.functions.identity import instance_of_provider, ip_of_node_name, node_identity
from feedarb.operators import (
    arbitrate,
    audit,
    ingest,
    recorded,
    removal,
    rollups,
    tally,
    windows,
)
from feedarb.params import RemovalParams
from feedarb.plans.settings import AUDIT_PARTITIONS, OBSERVE, REMOVAL, STALL, TOPIC_PARTITIONS
from feedarb.plans.storage import durable
from feedarb.sources import derived, kafka
from feedarb.sources.catalogue import stream_catalogue
from feedarb.sources.landing import GROUP

Report = Callable[[SparkSession, str], DataFrame]
KEY = arbitrate.KEY


def slowest_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source is slowest for each stream and symbol?"""
    feed = derived.copies(spark, sf_dir)
    firsts = arbitrate.first_copies(feed, ("source_id",)).withColumnRenamed("source_id", "winner")
    present = windows.roster(feed).select(*GROUP, "source_id")
    wins = tally.zero_filled_wins(present, firsts, GROUP)
    return tally.verdicts(wins, GROUP, minimum_events=100)


def arbitrated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.copies(spark, sf_dir)
    return arbitrate.first_copies(feed, ("source_id", "arr_us", "value")).withColumnRenamed(
        "first_offset", "seq_offset"
    )


def copy_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.copies(spark, sf_dir)
    return arbitrate.classify_copies(feed).select(*KEY, "source_id", "seq_offset", "outcome")


def arrival_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.copies(spark, sf_dir)
    return arbitrate.arrival_ranks(feed).select(
        *KEY, "source_id", "seq_offset", "arrival_rank", "lag_offsets"
    )


def arrival_lag_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arbitrate.lag_by_source(derived.copies(spark, sf_dir))


def copies_seen_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arbitrate.copies_per_event(derived.copies(spark, sf_dir))


def evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arbitrate.evictions(derived.copies(spark, sf_dir), OBSERVE).drop(
        "first_us", "late_copy"
    )


def readmission_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arbitrate.certificate(arbitrate.evictions(derived.copies(spark, sf_dir), OBSERVE))


def pending_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arbitrate.pending_entries(arbitrate.evictions(derived.copies(spark, sf_dir), OBSERVE))


def gate_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = windows.roster(derived.copies(spark, sf_dir))
    return windows.gate_opening(sources, OBSERVE.expected_sources)


def _observed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Credited evictions, roster and gates of the feed without redeliveries."""
    feed = derived.copies(spark, sf_dir, redelivery=False)
    # Many small uses of one pass over all copies.
    sources = durable(windows.roster(feed), "roster")
    gates = windows.gate_opening(sources, OBSERVE.expected_sources)
    evicted = arbitrate.evictions(feed, OBSERVE)
    return windows.credited(evicted, gates, OBSERVE), sources, gates


def observe_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = windows.roster(derived.copies(spark, sf_dir, redelivery=False))
    gates = windows.gate_opening(sources, OBSERVE.expected_sources)
    return windows.observe_windows(gates, OBSERVE)


def window_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit, sources, gates = _observed(spark, sf_dir)
    return tally.window_wins(credit, sources, gates, OBSERVE)


def win_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.win_runs(*_observed(spark, sf_dir), OBSERVE)


def window_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts as if nobody left; ``exact`` up to each group's first named source, from which
    on a live system goes without it."""
    told = durable(tally.verdicts_by_runs(*_observed(spark, sf_dir), OBSERVE), "verdicts")
    first = told.where(F.col("slowest_source_id").isNotNull()).groupBy(*GROUP).agg(
        F.min("window_no").alias("_first_named")
    )
    return (
        told.join(first, [*GROUP], "left")
        .withColumn("exact", F.coalesce(F.col("window_no") <= F.col("_first_named"), F.lit(True)))
        .drop("_first_named")
    )


def running_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit, sources, _ = _observed(spark, sf_dir)
    return tally.running_tallies(credit, sources, OBSERVE)


def raw_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.validate_raw(derived.raw_copies(spark, sf_dir)).select(
        *KEY, "source_id", F.col("offset").alias("seq_offset"), "drop_reason"
    )


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = derived.captured_lines(spark, sf_dir)
    return ingest.shape_captured(captured, stream_catalogue(spark)).select(
        "event_id", *KEY, "drop_reason"
    )


def dropped_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ingest.validate_raw(derived.raw_copies(spark, sf_dir))
    captured = derived.captured_lines(spark, sf_dir)
    return ingest.dropped_by_reason(
        raw, ingest.shape_captured(captured, stream_catalogue(spark))
    )


def parsed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("msg_key")
    return derived.written_keys(spark, sf_dir).select(
        "event_id",
        keys.key_prefix(key).alias("key_prefix"),
        keys.key_event_id(key).alias("key_event_id"),
        keys.key_is_malformed(key).alias("malformed"),
    )


def topic_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of every (market segment, customer) pair taken as stream and symbol."""
    pairs = derived.table(spark, sf_dir, "customer")
    stream, symbol = F.col("c_mktsegment"), F.col("c_name")
    return pairs.select(
        "c_custkey",
        keys.topic_partition(stream, symbol, TOPIC_PARTITIONS).alias("partition_6"),
        keys.topic_partition(stream, symbol, 1000).alias("partition_1000"),
    )


def audit_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived.table(spark, sf_dir, "events")
    stream = F.expr(derived.CAPTURED_STREAM)
    return events.select(
        "event_id",
        keys.audit_partition(stream, AUDIT_PARTITIONS).alias("partition_3"),
        keys.audit_partition(stream, 2).alias("partition_2"),
    )


def retired_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As small as a recorded log of removals is, and known to be.
    return durable(derived.retirements(spark, sf_dir), "retired")


def tumbling_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = arbitrate.first_copies(derived.copies(spark, sf_dir)).withColumnRenamed(
        "source_id", "winner"
    )
    return rollups.tumbling_leaderboard(firsts, "1 day")


def ignore_filtered_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = recorded.ignored_from(retired_sources(spark, sf_dir))
    feed = arbitrate.drop_ignored(derived.copies(spark, sf_dir), gone)
    return arbitrate.first_copies(feed, ("source_id", "arr_us"))


def _filtered(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Recorded removals, the feed without the removed sources, and its roster."""
    named = retired_sources(spark, sf_dir)
    feed = arbitrate.drop_ignored(derived.copies(spark, sf_dir), recorded.ignored_from(named))
    return named, feed, durable(windows.roster(feed), "roster")


def gate_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, feed, sightings = _filtered(spark, sf_dir)
    return recorded.gate_closures(feed, sightings, named, STALL)


def gate_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, feed, sightings = _filtered(spark, sf_dir)
    closures = recorded.gate_closures(feed, sightings, named, STALL)
    return windows.stall_warnings(
        closures, sightings, recorded.ignored_from(named), STALL
    ).withColumn("ignored_sources", F.array_join("ignored_sources", ","))


def feed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = recorded.ignored_from(retired_sources(spark, sf_dir))
    return rollups.feed_counters(arbitrate.flag_ignored(derived.copies(spark, sf_dir), gone))


def audit_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window verdicts as they would be written to the audit log."""
    wins = durable(window_wins(spark, sf_dir), "wins")
    window = [*GROUP, "window_no"]
    sources = windows.roster(derived.copies(spark, sf_dir, redelivery=False))
    gates = windows.gate_opening(sources, OBSERVE.expected_sources)
    messages = (
        tally.verdicts(wins, window, OBSERVE.minimum_events)
        .join(tally.counts_map(wins, window), window)
        .join(windows.observe_windows(gates, OBSERVE), window)
        .withColumns(
            {
                "window_start": audit.wire_seconds(F.col("window_start_us")),
                "window_end": audit.wire_seconds(F.col("window_end_us")),
            }
        )
    )
    return _as_text(audit.encode(messages, "verdict", AUDIT_PARTITIONS))


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
    )


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.decode(derived.audit_log(spark, sf_dir).select("partition", "offset", "value"))


def audit_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select(
        "partition",
        "offset",
        "decode_status",
        "message_type",
        *GROUP,
        "slowest_source_id",
        "source_id",
        "instance_id",
        "window_end",
        "emitted_at",
        "terminated_at",
        F.col("counts")["a"].alias("count_a"),
        F.col("counts")["b"].alias("count_b"),
        "total_events",
        "sources_seen",
        "sources_confirmed",
        F.array_join("ignored_sources", ",").alias("ignored_sources"),
        "reason",
        "correlation_id",
        "is_actionable",
    )


def audit_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.confirmations_before_verdict(_decoded(spark, sf_dir))


def audit_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.audit_traffic(_decoded(spark, sf_dir))


def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.verdict_counts(_decoded(spark, sf_dir))


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.audit_counts(_decoded(spark, sf_dir))


def last_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.last_removal(_decoded(spark, sf_dir))


def node_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider, name = F.col("provider_id"), F.col("name")
    return derived.nodes(spark, sf_dir).select(
        "name",
        instance_of_provider(provider).alias("provider_instance"),
        ip_of_node_name(name).alias("name_ip"),
        node_identity(provider, name)["private_ip"].alias("lookup_ip"),
    )


def _actions(spark: SparkSession, sf_dir: str, decoded: DataFrame) -> DataFrame:
    """Actions with earlier successful removals taken into account.

    A removal counts as handled only if the node could be removed and its machine
    was found.
    """
    ready = removal.inventory(
        derived.nodes(spark, sf_dir), derived.instances(spark, sf_dir), REMOVAL
    ).where(F.col("label_problem").isNull() & removal.resolved())
    tried = derived.removal_outcomes(spark, sf_dir).join(
        ready.select(F.col("node_name").alias("source_id")), "source_id", "left_semi"
    )
    return removal.verdict_actions(decoded, removal.handled_sources(tried))


def verdict_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, _decoded(spark, sf_dir)).select(
        "partition", "offset", "act", "action_reason"
    )


def _plan(
    spark: SparkSession, sf_dir: str, decoded: DataFrame, params: RemovalParams = REMOVAL
) -> DataFrame:
    return removal.removal_plan(
        _actions(spark, sf_dir, decoded),
        derived.nodes(spark, sf_dir),
        derived.instances(spark, sf_dir),
        params,
    )


def removal_plan_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dry run and a job that only cordons would do about the same verdicts."""
    decoded = durable(_decoded(spark, sf_dir), "decoded")
    modes = {
        "dry_run": RemovalParams(dry_run=True, terminate_enabled=True),
        "cordon_only": RemovalParams(dry_run=False, terminate_enabled=False),
    }
    plans = [
        _plan(spark, sf_dir, decoded, params).select(
            F.lit(mode).alias("mode"), "partition", "offset", "source_id", "planned_action"
        )
        for mode, params in modes.items()
    ]
    return plans[0].unionByName(plans[1])


def removal_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, _decoded(spark, sf_dir)).select(
        "partition",
        "offset",
        *GROUP,
        "source_id",
        "planned_action",
        "label_problem",
        "private_ip",
        "instance_id",
        "identified_by",
    )


def confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir, _decoded(spark, sf_dir))
    settled = removal.with_outcomes(plan, derived.removal_outcomes(spark, sf_dir))
    return removal.confirmations(settled)


def confirmations_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmations as rows of the audit topic."""
    messages = confirmations(spark, sf_dir).withColumn(
        "terminated_at", audit.wire_seconds(F.col("terminated_us"))
    )
    return _as_text(audit.encode(messages, "kill_confirmed", AUDIT_PARTITIONS))


def stalls_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stall warnings as rows of the audit topic."""
    named, feed, sightings = _filtered(spark, sf_dir)
    closures = recorded.gate_closures(feed, sightings, named, STALL)
    messages = windows.stall_warnings(
        closures, sightings, recorded.ignored_from(named), STALL
    ).withColumns(
        {
            "stalled_for_seconds": audit.wire_seconds(F.col("stalled_for_us")),
            "emitted_at": audit.wire_seconds(F.col("emitted_us")),
        }
    )
    return _as_text(audit.encode(messages, "gate_stalled", AUDIT_PARTITIONS))


def arbitrated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copies of good broker messages as rows of the arbitrated topic."""
    good = ingest.validate_raw(derived.raw_copies(spark, sf_dir)).where("drop_reason is null")
    first = arbitrate.first_copies(
        good.withColumn("seq_offset", F.col("offset")), ("value", "headers")
    )
    return topic_rows(first)


def topic_rows(forwarded: DataFrame) -> DataFrame:
    """Rows of the arbitrated topic in readable form."""
    return kafka.arbitrated_rows(forwarded, TOPIC_PARTITIONS).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ",").alias("headers"),
        "partition",
    )


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker messages set aside, with where they were read and why."""
    return ingest.rejected_messages(derived.raw_copies(spark, sf_dir)).select(
        "topic", "partition", "offset", "drop_reason", F.col("key").cast("string").alias("key")
    )


def removal_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = durable(_plan(spark, sf_dir, _decoded(spark, sf_dir)), "plan")
    settled = removal.with_outcomes(plan, derived.removal_outcomes(spark, sf_dir))
    return rollups.removal_counters(plan, settled)


def kill_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = durable(_decoded(spark, sf_dir), "decoded")
    return removal.reconcile(
        removal.match_confirmations(decoded), _plan(spark, sf_dir, decoded)
    )


def confirm_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = removal.match_confirmations(durable(_decoded(spark, sf_dir), "decoded"))
    waited = F.col("confirmed_at") - F.col("window_end")
    # Log times are days apart in the derived feed; a minute here stands for a day.
    return rollups.duration_histogram(
        matched.where(F.col("confirmed_offset").isNotNull()), waited / F.lit(1440.0), GROUP
    )


def verdict_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window of a recorded log, recomputed with the sources it names left out from then on.

    The log was kept without leaving anybody out, and some of its totals are wrong.
    """
    window = [*GROUP, "window_no"]
    feed = derived.copies(spark, sf_dir, redelivery=False)
    gates = windows.gate_opening(windows.roster(feed), OBSERVE.expected_sources)
    log = (
        tally.verdicts(window_wins(spark, sf_dir), window, OBSERVE.minimum_events)
        .join(windows.observe_windows(gates, OBSERVE), window)
        .withColumn("total_events", F.expr(derived.RECORDED_TOTAL))
    )
    return recorded.recheck_verdicts(feed, durable(log, "log"), None, OBSERVE)


def queries() -> dict[str, Report]:
    return {
        "slowest_source": slowest_source,
        "arbitrated_feed": arbitrated_feed,
        "copy_classification": copy_classification,
        "arrival_ranks": arrival_ranks,
        "arrival_lag_by_source": arrival_lag_by_source,
        "copies_seen_per_key": copies_seen_per_key,
        "evictions": evictions,
        "readmission_certificate": readmission_certificate,
        "pending_entries": pending_entries,
        "raw_validation": raw_validation,
        "dropped_by_reason": dropped_by_reason,
        "message_keys": message_keys,
        "parsed_keys": parsed_keys,
        "topic_partition": topic_partition,
        "audit_partition": audit_partition,
        "gate_opening": gate_opening,
        "observe_windows": observe_windows,
        "window_wins": window_wins,
        "win_runs": win_runs,
        "window_verdicts": window_verdicts,
        "running_tallies": running_tallies,
        "tumbling_leaderboard": tumbling_leaderboard,
        "ignore_filtered_feed": ignore_filtered_feed,
        "gate_closures": gate_closures,
        "gate_stalls": gate_stalls,
        "audit_encoded": audit_encoded,
        "audit_decoded": audit_decoded,
        "audit_order_check": audit_order_check,
        "verdict_actions": verdict_actions,
        "node_identity": node_identities,
        "removal_plan": removal_plan,
        "confirmations": confirmations,
        "kill_reconciliation": kill_reconciliation,
        "feed_counters": feed_counters,
        "audit_traffic": audit_traffic,
        "verdict_counts": verdict_counts,
        "audit_counts": audit_counts,
        "removal_counters": removal_counters,
        "confirm_latency_histogram": confirm_latency_histogram,
        "last_removal": last_removal,
        "verdict_recheck": verdict_recheck,
        "removal_plan_modes": removal_plan_modes,
        "confirmations_encoded": confirmations_encoded,
        "stalls_encoded": stalls_encoded,
        "arbitrated_rows": arbitrated_rows,
        "rejected_messages": rejected_messages,
    }
