"""Windows and gate closures taken from a recorded audit log.

With the log at hand there is no feedback left to follow: who was ignored from
when, and which windows were measured, are joins.  Every published verdict can so
be recomputed from the copies without a sequential step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.functions.timing import int_div
from feedarb.operators.arbitrate import drop_ignored, evictions
from feedarb.operators.tally import verdicts
from feedarb.operators.windows import first_copy_after, roster
from feedarb.params import ArbitrationParams
from feedarb.plans.ordered import BLOCK_WIDTH
from feedarb.plans.storage import durable
from feedarb.sources.landing import GROUP

WINDOW = (*GROUP, "window_start_us", "window_end_us")


def ignored_from(named: DataFrame, confirmed: DataFrame | None = None) -> DataFrame:
    """(group, source_id, from_us): a source is ignored once named or confirmed gone."""
    sources = named.where(F.col("slowest_source_id").isNotNull()).select(
        *GROUP,
        F.col("slowest_source_id").alias("source_id"),
        F.col("window_end_us").alias("from_us"),
    )
    if confirmed is None:
        return sources
    return sources.unionByName(
        confirmed.select(*GROUP, "source_id", F.col("terminated_us").alias("from_us"))
    )


def gate_closures(
    feed: DataFrame, sightings: DataFrame, named: DataFrame, params: ArbitrationParams
) -> DataFrame:
    """(group, closed_us, until_us) for the cold start and every naming verdict.

    ``feed`` holds the copies without ignored ones, ``sightings`` its roster.

    The fleet is a running count: +1 when a source is first seen, -1 when a seen
    source is named for the first time.  The gate closes again with every later naming
    of a source that is gone already.  It reopens with the sighting that restores the count,
    or with the next copy if naming left enough sources.  Fleet changes number as
    many as machines; copies are only aggregated.
    """
    namings = ignored_from(named).withColumnRenamed("from_us", "at_us").distinct()
    first_named = namings.groupBy(*GROUP, "source_id").agg(F.min("at_us").alias("_gone_us"))
    leaves = (F.col("at_us") == F.col("_gone_us")) & (F.col("first_us") < F.col("at_us"))
    closing = (
        namings.join(first_named, [*GROUP, "source_id"])
        .join(sightings.select(*GROUP, "source_id", "first_us"), [*GROUP, "source_id"], "left")
        .select(
            *GROUP,
            "at_us",
            F.lit(0).alias("step"),
            "source_id",
            F.when(leaves, -1).otherwise(0).alias("change"),
        )
    )
    seen = sightings.select(
        *GROUP,
        F.col("first_us").alias("at_us"),
        F.lit(1).alias("step"),
        "source_id",
        F.lit(1).alias("change"),
    )
    in_time = W.partitionBy(*GROUP).orderBy("at_us", "step", "source_id")
    backwards = W.partitionBy(*GROUP).orderBy(
        F.desc("at_us"), F.desc("step"), F.desc("source_id")
    )
    enough = F.col("_present") >= params.expected_sources
    fleet = durable(
        closing.unionByName(seen)
        .withColumn(
            "_present",
            F.sum("change").over(in_time.rowsBetween(W.unboundedPreceding, 0)),
        )
        .withColumn(
            "_restored_us",
            F.min(F.when((F.col("step") == 1) & enough, F.col("at_us"))).over(
                backwards.rowsBetween(W.unboundedPreceding, -1)
            ),
        )
        .withColumn("_first_us", F.min("at_us").over(W.partitionBy(*GROUP))),
        "fleet",
    )
    next_copy = first_copy_after(feed, namings)
    ends = sightings.groupBy(*GROUP).agg(F.max("last_us").alias("last_us"))
    reopened = (
        fleet.where(F.col("step") == 0)
        .join(next_copy, [*GROUP, "at_us"], "left")
        .join(ends, [*GROUP])
        .select(
            *GROUP,
            F.col("at_us").alias("closed_us"),
            F.coalesce(
                F.when(enough, F.col("next_us")).otherwise(F.col("_restored_us")), "last_us"
            ).alias("until_us"),
        )
    )
    cold = (
        fleet.where(F.col("step") == 1)
        .groupBy(*GROUP)
        .agg(
            F.min("_first_us").alias("closed_us"),
            F.min(F.when(enough, F.col("at_us"))).alias("_opened_us"),
        )
        .join(ends, [*GROUP])
        .select(*GROUP, "closed_us", F.coalesce("_opened_us", "last_us").alias("until_us"))
    )
    return cold.unionByName(reopened)


def _slots(start_us: Column, end_us: Column, width_us: int) -> Column:
    return F.explode(F.sequence(int_div(start_us, width_us), int_div(end_us, width_us)))


def _opening_offsets(feed: DataFrame, sources: DataFrame, recorded: DataFrame) -> DataFrame:
    """First offset that counts for windows opened by the gate.

    Copies at the very instant of the opening may precede it; the opening copy is
    the first sighting at that instant, else the first copy.
    """
    at_start = feed.select(*GROUP, "seq_offset", F.col("arr_us").alias("window_start_us")).join(
        recorded.select(*GROUP, "window_start_us"), [*GROUP, "window_start_us"]
    )
    sighted = sources.select(
        *GROUP, F.col("first_offset").alias("seq_offset"), F.lit(True).alias("_sighting")
    )
    return (
        at_start.join(sighted, [*GROUP, "seq_offset"], "left")
        .groupBy(*GROUP, "window_start_us")
        .agg(
            F.coalesce(
                F.min(F.when(F.col("_sighting"), F.col("seq_offset"))), F.min("seq_offset")
            ).alias("open_offset")
        )
    )


def recorded_wins(
    copies: DataFrame,
    recorded: DataFrame,
    confirmed: DataFrame | None,
    params: ArbitrationParams,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Long-form wins of every recorded window, recomputed from the copies.

    ``recorded`` holds (group, window_start_us, window_end_us, slowest_source_id).
    Windows and instants meet in time slots as long as a window, so a window
    touches three slots at most and each eviction one.
    """
    gone = ignored_from(recorded, confirmed)
    feed = drop_ignored(copies, gone)
    sources = durable(roster(feed), "roster")
    windows = recorded.select(*WINDOW)
    after_close = recorded.where(F.col("slowest_source_id").isNull()).select(
        *GROUP, F.col("window_end_us").alias("window_start_us"), F.lit(True).alias("_follows")
    ).distinct()
    bounds = (
        windows.join(_opening_offsets(feed, sources, recorded), [*GROUP, "window_start_us"], "left")
        .join(after_close, [*GROUP, "window_start_us"], "left")
        .withColumn(
            "open_offset",
            F.when(F.col("_follows").isNull(), F.col("open_offset")),
        )
        .drop("_follows")
    )
    slot_us = params.period_us
    slotted = durable(
        bounds.withColumn(
            "_slot", _slots(F.col("window_start_us"), F.col("window_end_us") - 1, slot_us)
        ),
        "windows",
    )
    counted = (
        evictions(feed, params, width)
        .where(F.col("evict_offset").isNotNull())
        .select(
            *GROUP,
            F.col("winner").alias("source_id"),
            "evict_offset",
            "evict_us",
            int_div(F.col("evict_us"), slot_us).alias("_slot"),
        )
        .join(slotted, [*GROUP, "_slot"])
        .where(
            (F.col("evict_us") >= F.col("window_start_us"))
            & (F.col("evict_us") < F.col("window_end_us"))
            & (F.col("evict_offset") >= F.coalesce("open_offset", "evict_offset"))
        )
        .groupBy(*WINDOW, "source_id")
        .agg(F.count("*").alias("_wins"))
    )
    present = _presence(sources, gone, slotted, slot_us)
    # A winner removed meanwhile keeps its late credit, hence the full join.
    return present.join(counted, [*WINDOW, "source_id"], "full").select(
        *WINDOW, "source_id", F.coalesce("_wins", F.lit(0)).alias("wins")
    )


def _presence(
    sources: DataFrame, gone: DataFrame, slotted: DataFrame, slot_us: int
) -> DataFrame:
    """(window, source): seen by the window's end and not gone by its start."""
    ends = slotted.groupBy(*GROUP).agg(F.max("window_end_us").alias("_end_us"))
    first_gone = gone.groupBy(*GROUP, "source_id").agg(F.min("from_us").alias("_gone_us"))
    spans = (
        sources.select(*GROUP, "source_id", "first_us")
        .join(first_gone, [*GROUP, "source_id"], "left")
        .join(ends, [*GROUP])
        .withColumn("_until_us", F.least(F.coalesce("_gone_us", "_end_us"), "_end_us"))
        .where(F.col("first_us") <= F.col("_until_us"))
        .withColumn("_slot", _slots(F.col("first_us"), F.col("_until_us"), slot_us))
    )
    return (
        spans.join(slotted, [*GROUP, "_slot"])
        .where(
            (F.col("first_us") < F.col("window_end_us"))
            & (F.coalesce("_gone_us", "window_end_us") > F.col("window_start_us"))
        )
        .select(*WINDOW, "source_id")
        .distinct()
    )


def recheck_verdicts(
    copies: DataFrame,
    recorded: DataFrame,
    confirmed: DataFrame | None,
    params: ArbitrationParams,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Recorded verdicts beside what the copies say, with ``matched``.

    ``recorded`` also carries total_events, sources_seen and reason.
    """
    wins = recorded_wins(copies, recorded, confirmed, params, width)
    fields = ("slowest_source_id", "total_events", "sources_seen", "reason")
    again = verdicts(wins, WINDOW, params.minimum_events)
    equal = F.lit(True)
    for name in fields:
        equal = equal & F.col(f"_again.{name}").eqNullSafe(F.col(f"_said.{name}"))
    said = recorded.select(*WINDOW, *fields).alias("_said")
    same_window = [F.col(f"_said.{c}") == F.col(f"_again.{c}") for c in WINDOW]
    return said.join(again.alias("_again"), same_window, "left").select(
        *[F.col(f"_said.{c}").alias(c) for c in WINDOW],
        *[F.col(f"_said.{c}").alias(c) for c in fields],
        F.col("_again.total_events").alias("recomputed_events"),
        F.col("_again.slowest_source_id").alias("recomputed_slowest"),
        F.coalesce(equal, F.lit(False)).alias("matched"),
    )
