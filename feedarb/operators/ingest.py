"""From raw messages and captured lines to normalised copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedarb.functions.headers import header_bytes, is_broken_text, text_of
from feedarb.functions.json import is_json_object, normalised
from feedarb.functions.keys import message_key
from feedarb.sources.catalogue import with_catalogue


def validate_raw(raw: DataFrame) -> DataFrame:
    """Read headers and key of broker messages and say which must be dropped.

    The payload is passed on as it is and never parsed.  ``drop_reason`` is null
    for good messages; a missing header outranks a missing key.  Bytes that are not
    UTF-8 where text is needed give ``bad_encoding``.
    """
    names = ("stream_type", "symbol", "source_id")
    found = {f"_{name}": header_bytes(F.col("headers"), name) for name in names}
    read = _evaluated_once(_evaluated_once(raw, {"headers": F.col("headers")}), found).withColumns(
        {
            **{name: F.nullif(text_of(F.col(f"_{name}")), F.lit("")) for name in names},
            "msg_key": F.nullif(text_of(F.col("key")), F.lit("")),
        }
    )
    absent = broken = F.lit(False)
    for name in names:
        absent = absent | F.col(name).isNull()
        broken = broken | is_broken_text(F.col(f"_{name}"))
    return read.withColumn(
        "drop_reason",
        F.when(broken, "bad_encoding")
        .when(absent, "missing_header")
        .when(is_broken_text(F.col("key")), "bad_encoding")
        .when(F.col("msg_key").isNull(), "missing_key"),
    ).drop(*found)


def _evaluated_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Set columns that are worked out once a row, in however many places they are used.

    A plain projection is copied into every filter above it and into each use there; what a
    generator gives is not.
    """
    made = F.inline(F.array(F.struct(*(column.alias(name) for name, column in columns.items()))))
    return rows.select(*(name for name in rows.columns if name not in columns), made)


def normalised_copies(raw: DataFrame) -> DataFrame:
    """Good messages in the shape every arbitration operator takes."""
    return (
        validate_raw(raw)
        .where(F.col("drop_reason").isNull())
        .select(
            "stream_type",
            "symbol",
            "msg_key",
            "source_id",
            "partition",
            F.col("offset").alias("seq_offset"),
            F.unix_micros("timestamp").alias("arr_us"),
            "value",
        )
    )


def rejected_messages(raw: DataFrame) -> DataFrame:
    """Messages to set aside, with where they were read and why they were dropped."""
    return (
        validate_raw(raw)
        .where(F.col("drop_reason").isNotNull())
        .select("topic", "partition", "offset", "drop_reason", "key", "value", "headers")
    )


def shape_captured(captured: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Key captured JSON texts by the id field of their stream.

    Input: ``stream_type, symbol, source_id, line``.  Lines that are not one JSON
    object get ``bad_json``, lines without an id ``missing_id``.
    """
    path = F.concat(F.lit("$."), F.col("id_field"))
    event_id = F.coalesce(
        F.call_function("get_json_object", F.col("line"), path),
        F.call_function("get_json_object", normalised(F.col("line")), path),
    )
    valid = F.col("_valid")
    return (
        with_catalogue(captured, catalogue)
        .withColumn("_valid", is_json_object(F.col("line")))
        .withColumn("symbol", F.lower("symbol"))
        .withColumn("msg_key", F.when(valid, message_key(F.col("key_prefix"), event_id)))
        .withColumn(
            "drop_reason",
            F.when(F.col("id_field").isNull(), "unknown_stream")
            .when(~valid, "bad_json")
            .when(F.col("msg_key").isNull(), "missing_id"),
        )
        .drop("exchange_name", "key_prefix", "id_field", "_valid")
    )


def raw_messages(shaped: DataFrame, partition: Column) -> DataFrame:
    """Broker-shaped rows of good captured lines: key, untouched value, three headers."""
    headers = F.array(
        *[
            F.struct(F.lit(name).alias("key"), F.col(name).cast("binary").alias("value"))
            for name in ("source_id", "stream_type", "symbol")
        ]
    )
    return shaped.where(F.col("drop_reason").isNull()).select(
        F.col("msg_key").cast("binary").alias("key"),
        F.col("line").cast("binary").alias("value"),
        headers.alias("headers"),
        partition.alias("partition"),
    )


def dropped_by_reason(*checked: DataFrame) -> DataFrame:
    """Drop counts over any number of checked inputs."""
    reasons = [df.select("drop_reason") for df in checked]
    rows = reasons[0]
    for other in reasons[1:]:
        rows = rows.unionByName(other)
    return (
        rows.where(F.col("drop_reason").isNotNull())
        .groupBy("drop_reason")
        .agg(F.count("*").alias("dropped"))
    )
