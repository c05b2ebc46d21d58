"""First-arrival arbitration in closed form.

Every operator works on normalised copies: ``stream_type, symbol, msg_key,
source_id, arr_us, seq_offset`` and any payload.  Order inside a group is the
offset.  The closed form covers the first life of each event in the cache; the
certificate says for which groups that is the whole story.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.params import ArbitrationParams
from feedarb.plans.ordered import BLOCK_WIDTH, nth_next, running_number
from feedarb.plans.storage import durable
from feedarb.sources.landing import GROUP

# The key first: it tells rows apart early wherever they are sorted.
KEY = ("msg_key", *GROUP)
#: Parts in which events are counted, to find those with very many copies.
KEY_BUCKETS = 1 << 14


def first_copies(copies: DataFrame, carry: Sequence[str] = ("source_id", "arr_us")) -> DataFrame:
    """The copy of each event that arrived first, with the ``carry`` columns.

    ``min_by`` combines before the shuffle, so a much-repeated key costs one row
    per map task and payloads travel for candidates only.
    """
    return (
        copies.groupBy(*KEY)
        .agg(
            F.min("seq_offset").alias("first_offset"),
            F.min_by(F.struct(*carry), "seq_offset").alias("_first"),
        )
        .select(*KEY, "first_offset", "_first.*")
    )


def flag_ignored(copies: DataFrame, ignored_from: DataFrame) -> DataFrame:
    """Add ``ignored``: the source was named before the copy arrived.

    ``ignored_from`` holds (group, source_id, from_us) and may repeat sources.
    """
    earliest = ignored_from.groupBy(*GROUP, "source_id").agg(F.min("from_us").alias("_from"))
    return (
        copies.join(earliest, [*GROUP, "source_id"], "left")
        .withColumn("ignored", F.coalesce(F.col("arr_us") >= F.col("_from"), F.lit(False)))
        .drop("_from")
    )


def drop_ignored(copies: DataFrame, ignored_from: DataFrame) -> DataFrame:
    """Copies that reach the roster and the cache.  Runs below every aggregate."""
    return flag_ignored(copies, ignored_from).where(~F.col("ignored")).drop("ignored")


def classify_copies(copies: DataFrame) -> DataFrame:
    """Add ``outcome``: ignored, forwarded or duplicate.

    First copies are found again by their offset, which is unique in the group,
    so the join spreads evenly even if one key has most of the copies.
    """
    ignored = F.col("ignored") if "ignored" in copies.columns else F.lit(False)
    firsts = (
        copies.where(~ignored)
        .groupBy(*KEY)
        .agg(F.min("seq_offset").alias("seq_offset"))
        .select(*GROUP, "seq_offset", F.lit(True).alias("_first"))
    )
    return copies.join(firsts, [*GROUP, "seq_offset"], "left").select(
        *copies.columns,
        F.when(ignored, "ignored")
        .when(F.col("_first"), "forwarded")
        .otherwise("duplicate")
        .alias("outcome"),
    )


def arrival_ranks(copies: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Add ``arrival_rank`` within the event and ``lag_offsets`` behind its winner."""
    firsts = copies.groupBy(*KEY).agg(F.min("seq_offset").alias("_first"))
    return (
        running_number(copies, KEY, "seq_offset", "arrival_rank", width)
        .join(firsts, [*KEY])
        .withColumn("lag_offsets", F.col("seq_offset") - F.col("_first"))
        .drop("_first")
    )


def lag_by_source(copies: DataFrame) -> DataFrame:
    """How far each source arrives behind the winners, in offsets.

    Copies are summed per (event, source) first; the join then sees one row per
    source of an event however often the copies repeat.
    """
    per_source = copies.groupBy(*KEY, "source_id").agg(
        F.count("*").alias("_n"),
        F.sum("seq_offset").alias("_sum"),
        F.min("seq_offset").alias("_min"),
        F.max("seq_offset").alias("_max"),
    )
    firsts = copies.groupBy(*KEY).agg(F.min("seq_offset").alias("_first"))
    return (
        per_source.join(firsts, [*KEY])
        .groupBy(*GROUP, "source_id")
        .agg(
            F.sum("_n").alias("copies"),
            F.count_if(F.col("_min") == F.col("_first")).alias("firsts"),
            F.sum(F.col("_sum") - F.col("_n") * F.col("_first")).alias("total_lag"),
            F.max(F.col("_max") - F.col("_first")).alias("max_lag"),
        )
    )


def copies_per_event(copies: DataFrame) -> DataFrame:
    """Copies and distinct sources of each event."""
    return (
        copies.groupBy(*KEY, "source_id")
        .agg(F.count("*").alias("_n"))
        .groupBy(*KEY)
        .agg(F.sum("_n").alias("copies"), F.count("*").alias("distinct_sources"))
    )


def _first_of_sources(arrived: Column, most: int) -> Column:
    """The first copy of each of the first ``most`` sources, of copies in order of arrival."""
    sources = F.array_distinct(F.transform(arrived, lambda copy: copy["source_id"]))
    found = F.transform(
        F.slice(sources, 1, most),
        lambda source: F.get(F.filter(arrived, lambda copy: copy["source_id"].eqNullSafe(source)), F.lit(0)),
    )
    return F.when(F.size(sources) == F.size(arrived), F.slice(arrived, 1, most)).otherwise(found)


def _gathered_records(copies: DataFrame, expected_sources: int) -> DataFrame:
    """``event_records`` from all copies of an event at once.

    Copies of an event arrive near each other, so most meet before the shuffle.
    """
    copy = F.struct("seq_offset", "arr_us", "source_id")
    first = F.col("_firsts")[0]
    return (
        copies.groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(copy)).alias("_copies"))
        .select(
            *KEY,
            _first_of_sources(F.col("_copies"), expected_sources).alias("_firsts"),
            F.element_at("_copies", -1)["seq_offset"].alias("last_o"),
        )
        .select(
            *KEY,
            first["source_id"].alias("winner"),
            first["seq_offset"].alias("first_offset"),
            first["arr_us"].alias("first_us"),
            F.array(
                *(F.get(F.col("_firsts")["seq_offset"], F.lit(i)) for i in range(expected_sources))
            ).alias("early"),
            F.get(F.col("_firsts")["arr_us"], F.lit(expected_sources - 1)).alias("complete_us"),
            "last_o",
        )
    )


def _spread_records(copies: DataFrame, expected_sources: int) -> DataFrame:
    """``event_records`` of events with any number of copies.

    Only a source not yet counted moves an event towards completion, so repeats
    collapse to (first, last) offset per source before sources are put in order.
    The row-number filter keeps ``expected_sources + 1`` of them per event on both
    sides of the shuffle; the windows after it reuse its partitioning and order.
    ``last_o`` is the last copy of those sources: one source beyond completion is
    enough to prove a later copy, and with fewer sources none is missing.
    """
    per_source = copies.groupBy(*KEY, "source_id").agg(
        F.min("seq_offset").alias("o"),
        F.min_by("arr_us", "seq_offset").alias("at_us"),
        F.max("seq_offset").alias("last_o"),
    )
    in_order = W.partitionBy(*KEY).orderBy("o")
    earliest = per_source.withColumn("_nth", F.row_number().over(in_order)).where(
        F.col("_nth") <= expected_sources + 1
    )
    following = [F.lead("o", i).over(in_order) for i in range(1, expected_sources)]
    return (
        earliest.select(
            *KEY,
            "_nth",
            F.col("source_id").alias("winner"),
            F.col("o").alias("first_offset"),
            F.col("at_us").alias("first_us"),
            F.array("o", *following).alias("early"),
            F.lead("at_us", expected_sources - 1).over(in_order).alias("complete_us"),
            F.max("last_o").over(in_order.rowsBetween(0, expected_sources)).alias("last_o"),
        )
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )


def event_records(
    copies: DataFrame, expected_sources: int, hot_copies: int = BLOCK_WIDTH
) -> DataFrame:
    """One row per event: winner and the first offsets of its earliest sources.

    ``last_o`` is after every offset at which the event can leave the cache if any copy is.
    Events are counted by buckets of their keys' hashes.  Where a bucket has over ``hot_copies`` copies,
    one of its events may have too many for one row, and sources are put in order in small steps;
    the copies of all others are gathered.
    """
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(KEY_BUCKETS)).alias("_bucket")
    counted = copies.groupBy(bucket).agg(F.count("*").alias("_n"))
    hot = durable(counted.where(F.col("_n") > hot_copies).select("_bucket"), "hot")
    placed = copies.select(*KEY, "seq_offset", "arr_us", "source_id", bucket)
    usual = placed.join(hot, "_bucket", "left_anti")
    crowded = placed.join(hot, "_bucket", "left_semi")
    return _gathered_records(usual, expected_sources).unionByName(_spread_records(crowded, expected_sources))


def _by_lag(params: ArbitrationParams, value: str) -> Column:
    picked = F.col(f"{value}_after_{params.lag}")
    for stream, lag in params.lag_by_stream.items():
        picked = F.when(F.col("stream_type") == stream, F.col(f"{value}_after_{lag}")).otherwise(
            picked
        )
    return picked


def evictions(
    copies: DataFrame, params: ArbitrationParams, width: int = BLOCK_WIDTH
) -> DataFrame:
    """When, why and with what credit each event leaves the cache (first life).

    ``evict_offset`` is null for events still pending; ``late_copy`` marks events
    of which a copy arrived after eviction and so started a second life.
    """
    expected = params.expected_sources
    records = durable(event_records(copies, expected), "events")
    numbered = running_number(records, GROUP, "first_offset", "admitted_seq", width)
    lags = sorted({params.lag, *params.lag_by_stream.values()})
    aged = nth_next(
        numbered, GROUP, "admitted_seq", lags, ("first_offset", "first_us"), width
    )
    return (
        aged.withColumns(
            {
                "_complete_o": F.col("early")[expected - 1],
                "_stale_o": _by_lag(params, "first_offset"),
                "_stale_us": _by_lag(params, "first_us"),
            }
        )
        .withColumns(
            {
                "evict_offset": F.least("_complete_o", "_stale_o"),
                "complete": F.coalesce(
                    F.col("_complete_o") <= F.coalesce("_stale_o", "_complete_o"), F.lit(False)
                ),
            }
        )
        .select(
            *KEY,
            "winner",
            "first_offset",
            "first_us",
            "admitted_seq",
            "evict_offset",
            F.when(F.col("complete"), F.col("complete_us"))
            .otherwise(F.col("_stale_us"))
            .alias("evict_us"),
            "complete",
            F.size(F.filter("early", lambda o: o <= F.coalesce("evict_offset", o)))
            .cast("bigint")
            .alias("copies_seen"),
            F.coalesce(F.col("last_o") > F.col("evict_offset"), F.lit(False)).alias("late_copy"),
        )
    )


def certificate(evicted: DataFrame) -> DataFrame:
    """Per group: events, evictions and second lives.

    Where ``readmitted_keys`` is 0 the closed form is exact; send the other groups
    to the stateful operator.
    """
    return evicted.groupBy(*GROUP).agg(
        F.count("*").alias("keys"),
        F.count("evict_offset").alias("evicted"),
        F.count_if("complete").alias("completed"),
        F.count_if("late_copy").alias("readmitted_keys"),
    )


def pending_entries(evicted: DataFrame) -> DataFrame:
    """Events still in the cache at the end of the data, per group."""
    waiting = F.col("evict_offset").isNull()
    return evicted.groupBy(*GROUP).agg(
        F.count_if(waiting).alias("pending"),
        F.min(F.when(waiting, F.col("first_offset"))).alias("oldest_offset"),
    )
