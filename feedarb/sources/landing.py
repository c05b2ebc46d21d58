"""Landing a redundant feed: every copy gets its arrival offset.

A broker hands out offsets as copies arrive.  Copies that come without them are
put in arrival order by a range shuffle on the full order key, which balances
partitions even when one group or one instant holds most of the rows, and are
numbered from the partition sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.plans.storage import read_table, write_table

GROUP = ("stream_type", "symbol")


def _part() -> Column:
    """A slot is (partition, row in partition) packed in one number."""
    return F.shiftright("_slot", 33).alias("_part")


def land_with_offsets(
    df: DataFrame, order: Sequence[str], offset: str = "seq_offset", keys: Sequence[str] = GROUP
) -> DataFrame:
    """Written table with dense ``offset`` from 0 per group; ``order`` must be unique."""
    return read_landed(df.sparkSession, landed_paths(df, order, keys), offset, keys)


def landed_paths(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = GROUP
) -> tuple[str, str]:
    """Where the rows of ``land_with_offsets`` are written, and what their places are short of their offsets."""
    spark = df.sparkSession
    rows = write_table(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "placed",
    )
    spans = (
        read_table(spark, rows)
        .groupBy(*keys, _part())
        .agg(F.min("_slot").alias("_first"), F.count("*").alias("_rows"))
    )
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # Ranges are contiguous: at most (partitions + groups) rows.  Written, its size is
    # known, and the optimiser broadcasts it only below the session's threshold.
    starts = write_table(
        spans.select(
            *keys,
            "_part",
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias(
                "_shift"
            ),
        ),
        "starts",
    )
    return rows, starts


def read_landed(
    spark: SparkSession, paths: tuple[str, str], offset: str = "seq_offset", keys: Sequence[str] = GROUP
) -> DataFrame:
    """The table at ``landed_paths``; a reader adds up offsets, so rows are written once."""
    rows, starts = (read_table(spark, path) for path in paths)
    return (
        rows.withColumn("_part", _part())
        .join(starts, [*keys, "_part"])
        .withColumn(offset, F.col("_slot") + F.col("_shift"))
        .drop("_slot", "_part", "_shift")
    )
