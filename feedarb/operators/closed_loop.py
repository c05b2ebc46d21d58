"""The closed loop over a landed feed: windows, verdicts and removals that follow from them.

A verdict that names a source changes all that comes after it in its group: the source is
ignored, the gate closes and reopens with a full fleet, and windows start anew from there.
Between two namings nothing feeds back, so windows and verdicts are aggregates.  Hence rounds:
each takes all groups up to their next naming, and the groups that named a source go on from
there in the next round, as long as there are any.  There are as many rounds as a group has
namings; a round walks only through the blocks of copies from the last naming on.

Confirmed removals are a second input.  From then on the source is ignored and not in the
fleet any more, but the gate stays as it is.  A confirmation before a group's first copy has no
effect; at equal times ticks come first, then confirmations, then copies.

Times are microseconds; arrival times grow with offsets.  A window still open at the group's
last copy or confirmation is not closed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.functions.timing import int_div
from feedarb.operators.arbitrate import flag_ignored
from feedarb.operators.lives import BLOCK_OFFSETS, evictions_only, lives
from feedarb.operators.tally import verdicts
from feedarb.operators.windows import closed_windows, first_close, first_copy_after, roster, window_number
from feedarb.params import ArbitrationParams
from feedarb.plans.storage import durable
from feedarb.sources.landing import GROUP

WINDOW = (*GROUP, "window_start_us", "window_end_us")


class ClosedLoop(NamedTuple):
    """``wins``: (window, source_id, wins); ``verdicts`` by window; ``closures``: (group, closed_us,
    until_us), when the gate was closed; ``ignored``: (group, source_id, from_us)."""

    wins: DataFrame
    verdicts: DataFrame
    closures: DataFrame
    ignored: DataFrame


def _heard_sources(sources: DataFrame, gone: DataFrame) -> DataFrame:
    """Sources that reach the fleet, with ``gone_us`` from which on they are ignored; null: never."""
    gone_at = gone.groupBy(*GROUP, "source_id").agg(F.min("from_us").alias("gone_us"))
    return sources.join(gone_at, [*GROUP, "source_id"], "left").where(
        F.col("gone_us").isNull() | (F.col("first_us") < F.col("gone_us"))
    )


def _openings(heard: DataFrame, sources: DataFrame, since: DataFrame, expected: int) -> DataFrame:
    """(group, since_us, open_offset, open_us): the copy that opens the gate; null if none does.

    The fleet is a running count of sightings and departures, as many as machines.  The gate opens
    with a sighting that makes the fleet full, or with the first copy while it is full.
    """
    seen = sources.join(since.select(*GROUP), [*GROUP], "left_semi")
    none = F.lit(None).cast("bigint")
    changes = (
        seen.select(*GROUP, F.col("first_us").alias("at_us"), F.col("first_offset").alias("_copy"), F.lit(1).alias("_change"))
        .unionByName(
            seen.where("gone_us is not null").select(
                *GROUP, F.col("gone_us").alias("at_us"), none.alias("_copy"), F.lit(-1).alias("_change")
            )
        )
        # The point from which on is looked for: after the departures of its instant, before copies.
        .unionByName(since.select(*GROUP, F.col("since_us").alias("at_us"), none.alias("_copy"), F.lit(0).alias("_change")))
    )
    in_time = W.partitionBy(*GROUP).orderBy("at_us", F.asc_nulls_first("_copy"), "_change")
    steps = (
        changes.withColumns(
            {
                "_fleet": F.sum("_change").over(in_time.rowsBetween(W.unboundedPreceding, 0)),
                "_end_us": F.lead("at_us").over(in_time),
                "_end_copy": F.lead("_copy").over(in_time),
            }
        )
        .join(since, [*GROUP])
        .where((F.col("at_us") >= F.col("since_us")) & (F.col("_fleet") >= expected))
    )
    full = durable(steps, "full")
    waiting = full.where("_copy is null")
    after = first_copy_after(heard, waiting.select(*GROUP, "at_us"))
    by_copy = (
        waiting.join(after, [*GROUP, "at_us"])
        # The copy must come before the fleet changes; a change by a copy is a copy itself.
        .where(
            F.col("next_offset").isNotNull()
            & (
                F.col("_end_us").isNull()
                | (F.col("_end_copy").isNull() & (F.col("next_us") < F.col("_end_us")))
                | (F.col("next_offset") <= F.col("_end_copy"))
            )
        )
        .select(*GROUP, F.struct(F.col("next_offset").alias("o"), F.col("next_us").alias("us")).alias("_open"))
    )
    by_sighting = full.where("_copy is not null").select(*GROUP, F.struct(F.col("_copy").alias("o"), F.col("at_us").alias("us")).alias("_open"))
    opened = by_copy.unionByName(by_sighting).groupBy(*GROUP).agg(F.min("_open").alias("_open"))
    return since.join(opened, [*GROUP], "left").select(
        *GROUP, "since_us", F.col("_open.o").alias("open_offset"), F.col("_open.us").alias("open_us")
    )


def _window_wins(evicted: DataFrame, sources: DataFrame, gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """Wins of present sources and of late winners in every window that closes, as if nobody were named."""
    period, close = F.lit(params.period_us), first_close(params)
    number = F.col("window_no")
    open_gates = gates.where(F.col("open_us").isNotNull()).withColumn("_windows", closed_windows(params))
    counted = (
        evicted.join(open_gates, [*GROUP])
        .where(F.col("evict_offset") >= F.col("open_offset"))
        .withColumn("window_no", window_number(F.col("evict_us"), params))
        .where(number < F.col("_windows"))
        .groupBy(*GROUP, "window_no", F.col("winner").alias("source_id"))
        .agg(F.count("*").alias("_wins"))
    )
    first = window_number(F.greatest("first_us", "open_us"), params)
    # A window that a tick opens comes before departures of its instant, one that a copy opens after.
    last = F.when(F.col("gone_us").isNull(), F.col("_windows") - 1).when(
        F.col("gone_us") <= F.col("open_us"), F.lit(-1)
    ).otherwise(F.least(F.col("_windows") - 1, window_number(F.col("gone_us"), params)))
    present = (
        sources.join(open_gates, [*GROUP])
        .withColumns({"_from": first, "_to": last})
        .where("_from <= _to")
        .select(*GROUP, "source_id", F.explode(F.sequence("_from", "_to")).alias("window_no"))
    )
    start = F.when(number == 0, F.col("open_us")).otherwise(close + (number - 1) * period)
    return (
        present.join(counted, [*GROUP, "window_no", "source_id"], "full")
        .join(open_gates, [*GROUP])
        .select(
            *GROUP,
            "window_no",
            start.alias("window_start_us"),
            (close + number * period).alias("window_end_us"),
            "source_id",
            F.coalesce("_wins", F.lit(0)).alias("wins"),
        )
    )


def closed_loop(
    copies: DataFrame,
    params: ArbitrationParams,
    confirmed: DataFrame | None = None,
    width: int = BLOCK_OFFSETS,
) -> ClosedLoop:
    """What a live system with removals would have measured; ``confirmed`` has (group, source_id, terminated_us)."""
    ends = copies.groupBy(*GROUP).agg(F.min("arr_us").alias("started_us"), F.max("arr_us").alias("last_us"))
    nobody = copies.select(*GROUP, "source_id", F.col("arr_us").alias("from_us")).limit(0)
    gone = durable(nobody, "ignored")
    if confirmed is not None:
        known = durable(
            confirmed.select(*GROUP, "source_id", F.col("terminated_us").alias("from_us"))
            .join(ends.select(*GROUP, "started_us"), [*GROUP])
            .where(F.col("from_us") > F.col("started_us"))
            .drop("started_us"),
            "ignored",
        )
        latest = known.groupBy(*GROUP).agg(F.max("from_us").alias("_told_us"))
        ends = ends.join(latest, [*GROUP], "left").withColumn("last_us", F.greatest("last_us", "_told_us")).drop("_told_us")
        gone = known
    ends = durable(ends, "ends")
    # First sightings do not depend on removals, which only decide whether they count.
    sightings = durable(roster(copies).drop("last_us"), "roster")
    since = ends.select(*GROUP, F.col("started_us").alias("since_us"))
    resume = None
    wins, told, closures = [], [], []
    while True:
        from_here = copies.join(since, [*GROUP]).where(F.col("arr_us") >= F.col("since_us")).drop("since_us")
        heard = flag_ignored(from_here, gone).where(~F.col("ignored"))
        sources = durable(_heard_sources(sightings, gone), "fleet")
        opened = durable(_openings(heard, sources, since, params.expected_sources).join(ends, [*GROUP]), "gates")
        found = lives(copies, params, gone, width, resume)
        counted = durable(_window_wins(evictions_only(found), sources, opened, params), "window-wins")
        judged = durable(verdicts(counted, [*WINDOW, "window_no"], params.minimum_events), "judged")
        naming = durable(
            judged.where(F.col("slowest_source_id").isNotNull())
            .groupBy(*GROUP)
            .agg(F.min(F.struct("window_no", "window_end_us", "slowest_source_id")).alias("_first"))
            .select(*GROUP, "_first.*"),
            "naming",
        )
        until = naming.select(*GROUP, F.col("window_no").alias("_until"))
        for rows, kept in ((counted, wins), (judged, told)):
            kept.append(
                rows.join(until, [*GROUP], "left")
                .where(F.col("window_no") <= F.coalesce("_until", "window_no"))
                .drop("_until", "window_no")
            )
        closures.append(
            opened.select(*GROUP, F.col("since_us").alias("closed_us"), F.coalesce("open_us", "last_us").alias("until_us"))
        )
        if naming.isEmpty():
            return ClosedLoop(*map(_together, (wins, told, closures)), gone)
        gone = durable(
            gone.unionByName(naming.select(*GROUP, F.col("slowest_source_id").alias("source_id"), F.col("window_end_us").alias("from_us"))),
            "ignored",
        )
        since = naming.select(*GROUP, F.col("window_end_us").alias("since_us"))
        resume = _resumption(copies, found.ends, since, resume, width)


def _resumption(copies: DataFrame, ends: DataFrame, since: DataFrame, before: DataFrame | None, width: int) -> DataFrame:
    """(group, block, live): the block with the first copy after ``since``, and what is live where it begins."""
    later = copies.join(since, [*GROUP]).where(F.col("arr_us") >= F.col("since_us"))
    after = first_copy_after(later, since.withColumnRenamed("since_us", "at_us"))
    blocks = after.where("next_offset is not null").select(*GROUP, int_div(F.col("next_offset"), width).alias("block"))
    if before is not None:
        # What the walk itself began with counts as left by the block before.
        ends = ends.unionByName(before.select(*GROUP, (F.col("block") - 1).alias("block"), "live"))
    earlier = (
        ends.withColumnRenamed("block", "_of")
        .join(blocks, [*GROUP])
        .where(F.col("_of") < F.col("block"))
        .groupBy(*GROUP)
        .agg(F.max_by("live", "_of").alias("live"))
    )
    # A group without copies from there on has no more windows; its closed gate is still told.
    last = since.join(blocks, [*GROUP], "left").join(earlier, [*GROUP], "left")
    beyond = F.lit((1 << 62) // width)
    return durable(last.select(*GROUP, F.coalesce("block", beyond).alias("block"), F.coalesce("live", F.lit("[]")).alias("live")), "resume")


def _together(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found
