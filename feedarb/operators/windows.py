"""The fleet gate and measurement windows without feedback.

A group's gate opens when enough distinct sources have been seen.  Windows start
there, not on the clock: the first closes at the first tick at or after its full
length, later ones follow each other tick to tick.  Times are microseconds; a
tick runs before any copy that arrives at the same instant; a window still open
at the group's last arrival is not closed.

Without feedback means that naming a source has no effect.  Results equal the
live system up to and including a group's first named source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.functions.timing import int_div, next_tick
from feedarb.params import ArbitrationParams
from feedarb.plans.ordered import next_marked, running_sum
from feedarb.plans.storage import durable
from feedarb.sources.landing import GROUP

#: Length of the time slots in which the next copy is looked for.
SLOT_US = 60 * 1_000_000
#: Length of the blocks of time in which sources at a gate are counted.
STALL_WIDTH = 24 * 3600 * 1_000_000


def roster(copies: DataFrame) -> DataFrame:
    """First and last sighting of every source of a group."""
    return copies.groupBy(*GROUP, "source_id").agg(
        F.min("seq_offset").alias("first_offset"),
        F.min_by("arr_us", "seq_offset").alias("first_us"),
        F.max("arr_us").alias("last_us"),
    )


def gate_opening(sources: DataFrame, expected_sources: int) -> DataFrame:
    """Per group: first arrival, gate opening (null if never) and last arrival.

    ``sources`` is a roster, one row per machine.
    """
    in_order = W.partitionBy(*GROUP).orderBy("first_offset")
    opening = F.col("_nth") == expected_sources
    return (
        sources.withColumn("_nth", F.row_number().over(in_order))
        .groupBy(*GROUP)
        .agg(
            F.min_by("first_us", "first_offset").alias("started_us"),
            F.max(F.when(opening, F.col("first_offset"))).alias("open_offset"),
            F.max(F.when(opening, F.col("first_us"))).alias("open_us"),
            F.max("last_us").alias("last_us"),
        )
    )


def first_close(params: ArbitrationParams) -> Column:
    return next_tick(F.col("open_us") + F.lit(params.window_us))


def window_number(at_us: Column, params: ArbitrationParams) -> Column:
    """Window in which an instant falls; needs the group's ``open_us``."""
    close = first_close(params)
    return F.when(at_us < close, F.lit(0).cast("bigint")).otherwise(
        int_div(at_us - close, params.period_us) + 1
    )


def closed_windows(params: ArbitrationParams) -> Column:
    """How many windows close by the group's last arrival."""
    return window_number(F.col("last_us"), params)


def observe_windows(gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """Every closed window of every group with its bounds."""
    number = F.col("window_no")
    close = first_close(params)
    period = F.lit(params.period_us)
    return (
        gates.where(F.col("open_us").isNotNull() & (closed_windows(params) > 0))
        .withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("bigint"), closed_windows(params) - 1)))
        .select(
            *GROUP,
            "window_no",
            F.when(number == 0, F.col("open_us"))
            .otherwise(close + (number - 1) * period)
            .alias("window_start_us"),
            (close + number * period).alias("window_end_us"),
        )
    )


def credited(evicted: DataFrame, gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """Evictions that earn a win, with the window they fall into.

    Credit belongs to the moment of eviction.  The gate opens before the opening
    copy reaches the cache, so that copy's own eviction counts.
    """
    return (
        evicted.where(F.col("evict_offset").isNotNull())
        .join(gates, [*GROUP])
        .where(F.col("evict_offset") >= F.col("open_offset"))
        .withColumn("window_no", window_number(F.col("evict_us"), params))
        .withColumn("window_closed", F.col("window_no") < closed_windows(params))
    )


def presence_runs(sources: DataFrame, gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """(group, source, from_window, to_window): closed windows by whose end it was confirmed or publishing.

    One row per source, however many windows it stays.
    """
    return (
        sources.drop("last_us")
        .join(gates, [*GROUP])
        .where(F.col("open_us").isNotNull())
        .select(
            *GROUP,
            "source_id",
            "first_offset",
            window_number(F.greatest("first_us", "open_us"), params).alias("from_window"),
            (closed_windows(params) - 1).alias("to_window"),
        )
        .where("from_window <= to_window")
    )


def window_presence(sources: DataFrame, gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """(group, closed window, source): sources confirmed or publishing by its close."""
    return presence_runs(sources, gates, params).select(
        *GROUP,
        "source_id",
        F.explode(F.sequence("from_window", "to_window")).alias("window_no"),
    )


def first_copy_after(feed: DataFrame, points: DataFrame) -> DataFrame:
    """Offset and arrival of the first copy at or after each point (group, at_us), null if none.

    Copies are combined per time slot, and only slots that hold a point are looked into.
    """
    slot = int_div(F.col("arr_us"), SLOT_US).alias("_slot")
    # Offsets and times apart: an aggregate of two numbers needs no sort.
    copy = [F.min("seq_offset").alias("_o"), F.min_by("arr_us", "seq_offset").alias("_us")]
    pair = F.struct(F.col("_o").alias("seq_offset"), F.col("_us").alias("arr_us"))
    asked = durable(points.select(*GROUP, "at_us", int_div(F.col("at_us"), SLOT_US).alias("_slot")).distinct(), "points")
    placed = feed.select(*GROUP, "seq_offset", "arr_us", slot)
    near = (
        placed.join(asked, [*GROUP, "_slot"])
        .where(F.col("arr_us") >= F.col("at_us"))
        .groupBy(*GROUP, "at_us")
        .agg(*copy)
        .select(*GROUP, "at_us", pair.alias("_near"))
    )
    firsts = placed.groupBy(*GROUP, "_slot").agg(*copy).select(*GROUP, "_slot", pair.alias("_copy"))
    none = F.lit(None).cast("struct<seq_offset: bigint, arr_us: bigint>")
    run = durable(
        firsts.unionByName(asked.select(*GROUP, "_slot").distinct().withColumn("_copy", none))
        .groupBy(*GROUP, "_slot")
        .agg(F.max("_copy").alias("_copy")),
        "slots",
    )
    later = next_marked(run, GROUP, "_slot", F.col("_copy").isNotNull(), ["_copy"], "_next")
    return (
        asked.join(near, [*GROUP, "at_us"], "left")
        .join(later.select(*GROUP, "_slot", F.col("_next._copy").alias("_later")), [*GROUP, "_slot"])
        .withColumn("_copy", F.coalesce("_near", "_later"))
        .select(*GROUP, "at_us", F.col("_copy.seq_offset").alias("next_offset"), F.col("_copy.arr_us").alias("next_us"))
    )


def stall_warnings(
    closures: DataFrame, sightings: DataFrame, ignored_from: DataFrame, params: ArbitrationParams
) -> DataFrame:
    """Warnings while a gate stays closed, repeated at the warning interval.

    ``closures`` holds (group, closed_us, until_us): the gate was closed from
    ``closed_us`` up to its opening, or up to the end of the data.  ``sightings``
    holds (group, source_id, first_us).  Evaluated on ticks; a live gate also
    looks at every copy, which can put a warning under a second earlier.
    """
    first = next_tick(F.col("closed_us") + F.lit(params.stall_us))
    step = F.lit(max(int(-(-params.stall_us // 1_000_000)), 1) * 1_000_000)
    warned = (
        closures.where(first <= F.col("until_us"))
        .withColumn("emitted_us", F.explode(F.sequence(first, F.col("until_us"), step)))
        .select(*GROUP, "closed_us", "emitted_us")
    )
    warned = durable(warned, "warned")
    earliest = durable(ignored_from.groupBy(*GROUP, "source_id").agg(F.min("from_us").alias("from_us")), "gone")
    # A source counts after its first sighting and before it is gone: changes by instant, summed up.
    seen = sightings.join(earliest, [*GROUP, "source_id"], "left").select(
        *GROUP, (F.col("first_us") + 1).alias("at_us"), F.col("from_us").alias("gone_us")
    )
    seen = seen.where("gone_us is null or gone_us > at_us")
    none = F.lit(0).cast("bigint")
    changes = (
        seen.select(*GROUP, "at_us", (none + 1).alias("_change"))
        .union(seen.where("gone_us is not null").select(*GROUP, "gone_us", none - 1))
        .union(warned.select(*GROUP, "emitted_us", none))
        .groupBy(*GROUP, "at_us")
        .agg(F.sum("_change").alias("_change"))
    )
    counted = running_sum(durable(changes, "changes"), GROUP, "at_us", F.col("_change"), "sources_confirmed", STALL_WIDTH)
    counted = counted.select(*GROUP, F.col("at_us").alias("emitted_us"), "sources_confirmed")
    # A message names who is gone, so this list is as long as the message.
    named = (
        warned.join(earliest, [*GROUP])
        .where("from_us <= emitted_us")
        .groupBy(*GROUP, "closed_us", "emitted_us")
        .agg(F.array_sort(F.collect_list("source_id")).alias("ignored_sources"))
    )
    return (
        warned.join(counted, [*GROUP, "emitted_us"])
        .join(named, [*GROUP, "closed_us", "emitted_us"], "left")
        .select(
            *GROUP,
            "closed_us",
            "emitted_us",
            "sources_confirmed",
            F.coalesce("ignored_sources", F.array().cast("array<string>")).alias("ignored_sources"),
            F.lit(params.expected_sources).cast("bigint").alias("sources_expected"),
            (F.col("emitted_us") - F.col("closed_us")).alias("stalled_for_us"),
        )
    )
