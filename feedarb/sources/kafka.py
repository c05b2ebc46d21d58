"""Options for reading and writing the topics of a live deployment.

Thin on purpose: the connector does the work.  It is a separate package and may
be absent; nothing else in this library needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedarb.functions.keys import topic_partition

# Topic names and the delivery contract of the producers.
RAW_TOPIC = "market-data-raw"
ARBITRATED_TOPIC = "market-data-arb"
AUDIT_TOPIC = "arbitration-audit"
MAX_OFFSETS = 1_000_000
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "5",
    "kafka.linger.ms": "5",
}


def source_options(
    servers: str, topic: str, start: str = "earliest", max_offsets: int = MAX_OFFSETS
) -> dict[str, str]:
    """Reader options; ``max_offsets`` bounds what one micro-batch brings, a backlog included."""
    if start not in ("earliest", "latest"):
        raise ValueError("start must be 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": str(max_offsets),
    }
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_OPTIONS}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded).load()


def write_topic(rows: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Writer for rows with ``key, value`` and optionally ``headers, partition``."""
    return (
        rows.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    )


def arbitrated_rows(forwarded: DataFrame, partitions: int) -> DataFrame:
    """Forwarded copies as sink rows: key, value and headers untouched."""
    return forwarded.select(
        F.col("msg_key").cast("binary").alias("key"),
        "value",
        "headers",
        topic_partition(F.col("stream_type"), F.col("symbol"), partitions).alias("partition"),
    )
