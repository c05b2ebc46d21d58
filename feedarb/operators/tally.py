"""Win counts, running tallies and verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb import texts
from feedarb.functions.timing import int_div
from feedarb.operators.windows import observe_windows, presence_runs, window_presence
from feedarb.params import ArbitrationParams
from feedarb.plans.ordered import BLOCK_WIDTH, running_number, running_sum
from feedarb.plans.storage import durable
from feedarb.sources.landing import GROUP


def zero_filled_wins(presence: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form (keys, source_id, wins): every present source, winless ones at 0.

    ``winners`` has one row per credited event with its ``winner``.
    """
    counted = winners.groupBy(*keys, F.col("winner").alias("source_id")).agg(
        F.count("*").alias("_wins")
    )
    return presence.join(counted, [*keys, "source_id"], "left").select(
        *keys, "source_id", F.coalesce("_wins", F.lit(0)).alias("wins")
    )


def window_wins(
    credit: DataFrame, sources: DataFrame, gates: DataFrame, params: ArbitrationParams
) -> DataFrame:
    """Wins per source in every closed window."""
    return zero_filled_wins(
        window_presence(sources, gates, params),
        credit.where("window_closed"),
        [*GROUP, "window_no"],
    )


def _won(credit: DataFrame, runs: DataFrame) -> DataFrame:
    """(group, closed window, source, wins) of sources that won, with their runs' other columns."""
    counted = (
        credit.where("window_closed")
        .groupBy(*GROUP, "window_no", F.col("winner").alias("source_id"))
        .agg(F.count("*").alias("wins"))
    )
    return counted.join(runs, [*GROUP, "source_id"]).where("window_no between from_window and to_window")


def win_runs(credit: DataFrame, sources: DataFrame, gates: DataFrame, params: ArbitrationParams) -> DataFrame:
    """``window_wins`` by runs: a row per window that a source won in, and one per run of winless windows.

    Grows with wins, not with windows times sources.
    """
    runs = durable(presence_runs(sources, gates, params), "runs")
    won = durable(_won(credit, runs).select(*GROUP, "source_id", "window_no", "wins"), "won")
    lone = F.col("window_no")
    # Rows between which a source may have won nothing: its wins, and the window before it came.
    marks = won.unionByName(
        runs.select(*GROUP, "source_id", (F.col("from_window") - 1).alias("window_no"), F.lit(None).cast("bigint").alias("wins"))
    )
    following = F.lead("window_no").over(W.partitionBy(*GROUP, "source_id").orderBy("window_no"))
    winless = (
        marks.withColumn("_next", following)
        .join(runs.select(*GROUP, "source_id", "to_window"), [*GROUP, "source_id"])
        .select(
            *GROUP,
            "source_id",
            (lone + 1).alias("from_window"),
            F.coalesce(F.col("_next") - 1, F.col("to_window")).alias("to_window"),
            F.lit(0).cast("bigint").alias("wins"),
        )
        .where("from_window <= to_window")
    )
    return won.select(*GROUP, "source_id", lone.alias("from_window"), lone.alias("to_window"), "wins").unionByName(winless)


def verdicts_by_runs(
    credit: DataFrame, sources: DataFrame, gates: DataFrame, params: ArbitrationParams
) -> DataFrame:
    """``verdicts`` of ``window_wins``, without a row per window and winless source.

    Who was present is a running count of arrivals by window.  Sources have a number in their group;
    where just one of those present won nothing, its number is the sum of the numbers present
    less those of the winners.
    """
    runs = presence_runs(sources, gates, params)
    runs = durable(running_number(runs, GROUP, "first_offset", "_code"), "runs")
    came = runs.groupBy(*GROUP, F.col("from_window").alias("window_no")).agg(
        F.count("*").alias("_came"), F.sum("_code").alias("_came_code")
    )
    present = observe_windows(gates, params).select(*GROUP, "window_no").join(came, [*GROUP, "window_no"], "left")
    for amount, name in (("_came", "sources_seen"), ("_came_code", "_codes")):
        present = running_sum(present, GROUP, "window_no", F.coalesce(amount, F.lit(0)), name)
    window = [*GROUP, "window_no"]
    levels = _won(credit, runs).groupBy(*window, "wins").agg(
        F.count("*").alias("_n"), F.min("source_id").alias("_source"), F.sum("_code").alias("_code")
    )
    winners = levels.groupBy(*window).agg(
        F.sum(F.col("wins") * F.col("_n")).alias("total_events"),
        F.sum("_n").alias("_winners"),
        F.sum("_code").alias("_winner_codes"),
        F.min("wins").alias("_least"),
        F.min_by("_n", "wins").alias("_at_least"),
        F.min_by("_source", "wins").alias("_least_source"),
    )
    nothing = F.lit(0).cast("bigint")
    winless = F.col("sources_seen") - F.coalesce("_winners", nothing)
    judged = (
        present.where("sources_seen > 0")
        .join(winners, window, "left")
        .withColumn("_winless", winless)
        .withColumn("total_events", F.coalesce("total_events", nothing))
        .withColumn("_lowest", F.when(F.col("_winless") > 0, nothing).otherwise(F.col("_least")))
        .withColumn("_at_lowest", F.when(F.col("_winless") > 0, F.col("_winless")).otherwise(F.col("_at_least")))
        .withColumn("reason", _reason(params.minimum_events))
        .withColumn(
            "_code",
            F.when(F.col("_winless") == 1, F.col("_codes") - F.coalesce("_winner_codes", nothing)),
        )
    )
    named = judged.join(runs.select(*GROUP, "_code", F.col("source_id").alias("_lone")), [*GROUP, "_code"], "left")
    return named.select(
        *window,
        F.when(
            F.col("reason").isNull(),
            F.when(F.col("_winless") == 1, F.col("_lone")).otherwise(F.col("_least_source")),
        ).alias("slowest_source_id"),
        "total_events",
        "sources_seen",
        "reason",
    )


def _reason(minimum_events: int) -> Column:
    total, seen = F.col("total_events"), F.col("sources_seen")
    return (
        F.when(seen < 2, F.lit(texts.TOO_FEW_SOURCES))
        .when(
            total < minimum_events,
            F.format_string(texts.TOO_FEW_EVENTS, total, F.lit(minimum_events)),
        )
        .when(F.col("_at_lowest") > 1, F.format_string(texts.TIED, "_at_lowest", "_lowest"))
    )


def verdicts(wins: DataFrame, keys: Sequence[str], minimum_events: int) -> DataFrame:
    """The one source with the fewest wins per ``keys``, or why none is named.

    Sources are first gathered per number of wins, so a tie is a count and no
    list of sources is built.
    """
    levels = wins.groupBy(*keys, "wins").agg(
        F.count("*").alias("_n"), F.min("source_id").alias("_source")
    )
    return (
        levels.groupBy(*keys)
        .agg(
            F.sum(F.col("wins") * F.col("_n")).alias("total_events"),
            F.sum("_n").alias("sources_seen"),
            F.min("wins").alias("_lowest"),
            F.min_by("_n", "wins").alias("_at_lowest"),
            F.min_by("_source", "wins").alias("_slowest"),
        )
        .withColumn("reason", _reason(minimum_events))
        .select(
            *keys,
            F.when(F.col("reason").isNull(), F.col("_slowest")).alias("slowest_source_id"),
            "total_events",
            "sources_seen",
            "reason",
        )
    )


def counts_map(wins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wins as a map, one row per ``keys``; a map has one entry per machine."""
    return wins.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_id", "wins")))).alias(
            "counts"
        )
    )


def running_tallies(
    credit: DataFrame,
    sources: DataFrame,
    params: ArbitrationParams,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Long-form snapshots of an open window after every ``emit_tally_every`` wins.

    One copy causes at most one eviction, so a snapshot falls exactly on the
    eviction that completes a batch; the unfinished batch at the end emits none.
    """
    every = params.emit_tally_every
    window = (*GROUP, "window_no")
    numbered = durable(
        running_number(
            durable(credit.select(*window, "winner", "evict_offset", "evict_us"), "credit"),
            window,
            "evict_offset",
            "_n",
            width,
        ).withColumn("tally_no", int_div(F.col("_n") - 1, every)),
        "tallied",
    )
    batch = (*window, "tally_no")
    snapshots = numbered.where(F.col("_n") % every == 0).select(
        *batch,
        F.col("_n").alias("total_events"),
        F.col("evict_offset").alias("_at"),
        F.col("evict_us").alias("emitted_us"),
    )
    shown = (
        snapshots.join(sources.select(*GROUP, "source_id", "first_offset"), [*GROUP])
        .where(F.col("first_offset") <= F.col("_at"))
        .drop("_at", "first_offset")
    )
    gained = numbered.groupBy(*batch, F.col("winner").alias("source_id")).agg(
        F.count("*").alias("_gained")
    )
    filled = shown.join(gained, [*batch, "source_id"], "left")
    return running_sum(
        filled,
        [*window, "source_id"],
        "tally_no",
        F.coalesce("_gained", F.lit(0)),
        "wins",
        width,
    ).drop("_gained")
