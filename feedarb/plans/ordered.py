"""Running positions, sums and neighbours inside groups of any size.

A plain window over a group sorts the whole group in one task.  Here the order
column (a BIGINT, unique in its group, as broker offsets are) is cut into blocks
of fixed width, so a block holds at most ``width`` rows whatever the skew:

* inside a block a normal window does the work,
* one summary row per block goes through a second window over blocks,
* the two meet in an equi-join on (group, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.functions.timing import int_div

#: Offsets of a block: few enough that a task sorts several blocks, and that a group has many.
BLOCK_WIDTH = 1 << 17


def _blocked(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_block", int_div(F.col(order), width))


def _before_block(totals: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *keys, "_block", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias("_before")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    amount: Column,
    name: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``name`` = sum of ``amount`` over the rows of the group up to this one."""
    blocked = _blocked(df.withColumn("_amount", amount.cast("bigint")), order, width)
    totals = blocked.groupBy(*keys, "_block").agg(F.sum("_amount").alias("_total"))
    upto = (
        W.partitionBy(*keys, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        blocked.withColumn("_inside", F.sum("_amount").over(upto))
        .join(_before_block(totals, keys, "_total"), [*keys, "_block"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_block", "_amount", "_inside", "_before")
    )


def running_number(
    df: DataFrame, keys: Sequence[str], order: str, name: str, width: int = BLOCK_WIDTH
) -> DataFrame:
    """Add ``name`` = position of the row in its group, counted from 1."""
    return running_sum(df, keys, order, F.lit(1), name, width)


def nth_next(
    df: DataFrame,
    keys: Sequence[str],
    number: str,
    steps: Sequence[int],
    values: Sequence[str],
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add ``<value>_after_<step>``: ``value`` of the row ``step`` positions later.

    ``number`` is dense from 1 (see ``running_number``).  Each block also receives
    a copy of the first ``max(steps)`` rows of the next block, so every lookup
    stays inside one block.
    """
    reach = max(steps)
    width = max(width, reach)
    place = F.col(number) - 1
    home = int_div(place, width)
    seen_from_previous = (F.pmod(place, F.lit(width)) < reach) & (home > 0)
    spread = df.withColumn("_home", home).withColumn(
        "_block",
        F.explode(
            F.when(seen_from_previous, F.array(home, home - 1)).otherwise(F.array(home))
        ),
    )
    ahead = W.partitionBy(*keys, "_block").orderBy(number)
    found = {
        f"{value}_after_{step}": F.lead(value, step).over(ahead)
        for value in values
        for step in steps
    }
    return (
        spread.withColumns(found).where(F.col("_home") == F.col("_block")).drop("_home", "_block")
    )


def next_marked(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    marked: Column,
    carry: Sequence[str],
    name: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add the struct ``name`` = (order, ``carry`` columns) of the nearest later row
    of the group with ``marked``; null if there is none."""
    blocked = _blocked(
        df.withColumn("_mark", F.when(marked, F.struct(order, *carry))), order, width
    )
    firsts = blocked.groupBy(*keys, "_block").agg(F.min("_mark").alias("_first"))
    # Descending order keeps the frame a growing one, which costs one pass.
    later_blocks = (
        W.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1)
    )
    beyond = firsts.select(*keys, "_block", F.min("_first").over(later_blocks).alias("_beyond"))
    later_rows = (
        W.partitionBy(*keys, "_block")
        .orderBy(F.desc(order))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        blocked.withColumn("_near", F.min("_mark").over(later_rows))
        .join(beyond, [*keys, "_block"])
        .withColumn(name, F.coalesce("_near", "_beyond"))
        .drop("_block", "_mark", "_near", "_beyond")
    )
