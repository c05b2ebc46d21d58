"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of words by its weight, at most ``most`` times what it has; what
that leaves over goes to the other sources by weight until none is above.  A source first
takes all its documents as often as whole copies fit its target.  The rest of the target is
a sample without replacement in which a document's part p grows with a power of its size, so
that the parts' words add up to the rest.  Where p would be 1 or more the document is certain and
comes once more; the others are ranked by u / (1 - u) over p / (1 - p), where u is a number
that only the id decides, and the lowest ranks are taken while their words fit.  One more
document then closes the gap as nearly as one can.

Nothing is sorted as a whole: words are summed by source and slice of the rank's range, and
only the slice where the target is reached is ordered, about 1 in 4,096 of a source.  Parts are
found from the different sizes of a source, at most the root of twice its words.
Rows that share id, source and size are taken alike.  Documents without words are never
taken; a null source is a source of its own, the last in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedarb.llm.shared import unit, word_count
from feedarb.plans.storage import durable

WEIGHTS = (5, 2, 1)
SLICES = 4096
#: Power of a document's size that its part of the sample is in proportion to.
BY_SIZE = 0.5


def sources(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source``, its weight, its ``source_size`` and its ``target`` in words, one row each.

    ``sizes`` has source and size.  Weights repeat over the sources in order of code points.
    """
    placed = durable(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .select("source", "source_size", F.monotonically_increasing_id().alias("place")),
        "sources",
    )
    part, inner = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per task that wrote the sources.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("part")).count()
    starts = starts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    weighted = durable(
        placed.select("source", "source_size", part.alias("part"), inner.alias("inner"))
        .join(F.broadcast(starts), "part")
        .select(
            "source",
            "source_size",
            cycle[((F.col("start") + F.col("inner")) % len(weights)).cast("int")].alias("weight"),
        ),
        "weighted",
    )
    limit = F.col("source_size") * float(most)
    wanted = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, None  # words for a weight of 1; sources at their limit
    while True:
        is_full = limit <= F.lit(level) * F.col("weight")
        taken, open_weight, n = weighted.agg(
            F.sum(F.when(is_full, limit).otherwise(0.0)),
            F.sum(F.when(~is_full, F.col("weight")).otherwise(0.0)),
            F.count_if(is_full),
        ).first()
        if n == full or not open_weight:
            break
        full, level = n, (wanted - taken) / open_weight
    return weighted.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))


def _copies() -> Column:
    return F.coalesce(F.floor(_per_word()), F.lit(0))


def _per_word() -> Column:
    """How often a word of the source is wanted; null if it has none."""
    return F.try_divide(F.col("target"), F.col("source_size"))


def parts(sizes: DataFrame, planned: DataFrame, by_size: float = BY_SIZE) -> DataFrame:
    """Adds ``scale`` and ``certain`` to the plan of each source (``rest``: words still wanted).

    A document's part is ``scale`` times its size to the power ``by_size``; documents of more words
    than ``certain`` come for sure, ``rest`` is without them.  Going down from the largest size, a
    size is left to chance when its part of what the larger ones leave is below 1.
    """
    size = F.col("size").cast("double")
    classes = with_source(sizes.where("size > 0").groupBy("source", "size").count(), planned.where("rest > 0"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    above = F.sum(F.col("size") * F.col("count")).over(down.rowsBetween(Window.unboundedPreceding, -1))
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mass = F.sum(F.col("count") * F.pow(size, F.lit(1 + by_size))).over(up)
    left = F.col("rest") - F.coalesce(above, F.lit(0))
    chance = (
        classes.select("source", "size", left.alias("left"), (left / mass).alias("scale"))
        .where(F.col("scale") * F.pow(size, F.lit(by_size)) < 1)
        .groupBy("source")
        .agg(F.max(F.struct("size", "left", "scale")).alias("most"))
    )
    found = with_source(planned, durable(chance, "parts"), "left")
    return found.select(
        *(c for c in planned.columns if c != "rest"),
        F.coalesce("most.left", F.lit(0.0)).alias("rest"),
        F.col("most.scale").alias("scale"),
        F.col("most.size").alias("certain"),
    )


def _rank(seed: int, by_size: float) -> Column:
    """Pareto rank: odds of the document's number over odds of its part; null for those not left to chance."""
    u = unit(F.col("doc_id"), seed=seed)
    p = F.col("scale") * F.pow(F.col("size").cast("double"), F.lit(by_size))
    return F.when((F.col("size") > 0) & (F.col("size") <= F.col("certain")), (u / (1 - u)) / (p / (1 - p)))


def rules(sizes: DataFrame, planned: DataFrame, seed: int = 0, by_size: float = BY_SIZE) -> DataFrame:
    """Per source: whole copies, parts, the last rank taken of the sample, and the document that closes it.

    ``sizes`` has doc_id, source and size and should be a written table.
    """
    planned = planned.withColumn("whole", _copies().cast("long"))
    planned = planned.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    planned = durable(parts(sizes, planned, by_size), "parts")
    ranked = with_source(sizes, planned).withColumn("rank", _rank(seed, by_size)).where("rank is not null")
    ranked = ranked.withColumn("slice", F.floor(F.col("rank") / (1 + F.col("rank")) * SLICES))
    key = F.struct("rank", "doc_id", "size")

    cut = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(cut), F.lit(0)))
    reached = slices.where("before <= rest and before + words > rest").select(
        "source", F.col("slice").alias("last_slice"), "before"
    )
    reached = durable(reached, "reached")
    edge = with_source(ranked, reached).where("slice = last_slice")
    # Equal rows are peers of the frame and come in together.
    running = Window.partitionBy("source").orderBy(key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("before") + F.sum("size").over(running))
    taken = edge.where("upto <= rest").groupBy("source").agg(
        F.max(key).alias("last"), F.max("upto").alias("sampled")
    )
    found = durable(
        reached.join(taken, reached["source"].eqNullSafe(taken["source"]), "left").select(
            reached["source"],
            "last_slice",
            "last",
            F.coalesce("sampled", "before").alias("sampled"),
        ),
        "cuts",
    )
    open_docs = (
        with_source(ranked, found)
        .where((F.col("slice") > F.col("last_slice")) | ((F.col("slice") == F.col("last_slice")) & (F.col("last").isNull() | (key > F.col("last")))))
        .where(F.col("size") < 2 * (F.col("rest") - F.col("sampled")))
        .groupBy("source", "doc_id", "size", "rank")
        .agg(F.sum("size").alias("words"), F.first(F.col("rest") - F.col("sampled")).alias("gap"))
        .where("words < 2 * gap")
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("gap") - F.col("words")), "rank", "doc_id", "size")).alias("close"))
    )
    found = with_source(found, open_docs, "left").drop("sampled")
    return with_source(planned, found, "left").select(
        "source", "source_size", "target", "whole", "scale", "certain", "last_slice", "last",
        F.when(F.col("close").isNotNull(), F.struct("close.rank", "close.doc_id", "close.size")).alias("close"),
    )


def with_source(rows: DataFrame, by_source: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on source, null to null; the columns of ``by_source`` must be new ones."""
    other = by_source.withColumnRenamed("source", "own_source")
    return rows.join(other, rows["source"].eqNullSafe(other["own_source"]), how).drop("own_source")


def mixed(docs: DataFrame, by_rules: DataFrame, seed: int = 0, by_size: float = BY_SIZE) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` (0, 1, 2) to rows with doc_id, source and size."""
    ranked = with_source(docs, by_rules).withColumn("rank", _rank(seed, by_size))
    slice_ = F.floor(F.col("rank") / (1 + F.col("rank")) * SLICES)
    key = F.struct("rank", "doc_id", "size")
    sampled = F.coalesce(
        (slice_ < F.col("last_slice")) | ((slice_ == F.col("last_slice")) & (key <= F.col("last"))) | (key == F.col("close")),
        F.lit(False),
    )
    # A sample that never reaches its target within the ranks has no last slice.
    without_slice = F.col("last_slice").isNull() & F.col("rank").isNotNull()
    certain = F.coalesce(F.col("size") > F.col("certain"), F.lit(False))
    once_more = F.when(sampled | without_slice | certain, 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.col("whole") + once_more).otherwise(0)
    return ranked.withColumn("copies", copies.cast("long")).drop(
        "rank", "whole", "scale", "certain", "last_slice", "last", "close"
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))


def mix(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    by_size: float = BY_SIZE,
) -> DataFrame:
    """The rules that mix ``sizes`` (doc_id, source, size; a written table)."""
    return durable(rules(sizes, sources(sizes, weights, share, most), seed, by_size), "rules")
