"""Stream catalogue: how each stream names its events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stream type, exchange name, key prefix, id field.
STREAMS = (
    ("trade", "trade", "t", "t"),
    ("depth", "depth", "d", "u"),
    ("aggtrade", "aggTrade", "aT", "a"),
)


def stream_catalogue(
    spark: SparkSession, extra: tuple[tuple[str, str, str, str], ...] = ()
) -> DataFrame:
    """The known streams; a new feed is one more row."""
    names = ("stream_type", "exchange_name", "key_prefix", "id_field")
    rows = [
        F.struct(*[F.lit(text).alias(name) for name, text in zip(names, row)])
        for row in (*STREAMS, *extra)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def with_catalogue(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Attach the catalogue row of each record's stream type, in any letter case.

    A catalogue is a handful of rows, which the planner sees and broadcasts by itself.
    """
    named = df.withColumn("stream_type", F.lower("stream_type"))
    return named.join(catalogue, "stream_type", "left")
