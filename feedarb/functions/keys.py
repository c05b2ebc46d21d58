"""Event keys and topic placement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audit partitions follow this order of stream types.
AUDIT_STREAM_ORDER = ("trade", "depth", "aggtrade")

_KEY_PATTERN = r"(?s)^([^:]+):(.+)$"


def message_key(prefix: Column, event_id: Column) -> Column:
    """``prefix:id``; null when the id is null."""
    return F.concat(prefix, F.lit(":"), event_id.cast("string"))


def key_is_malformed(key: Column) -> Column:
    return ~F.coalesce(key.rlike(_KEY_PATTERN), F.lit(False))


def key_prefix(key: Column) -> Column:
    return F.when(key.rlike(_KEY_PATTERN), F.regexp_extract(key, _KEY_PATTERN, 1))


def key_event_id(key: Column) -> Column:
    """The part after the first colon, as text."""
    return F.when(key.rlike(_KEY_PATTERN), F.regexp_extract(key, _KEY_PATTERN, 2))


def _digest_slot(material: Column, partitions: int) -> Column:
    # The first 8 digest bytes are an unsigned 64-bit number: beyond BIGINT, so DECIMAL.
    head = F.conv(F.substring(F.sha2(material, 256), 1, 16), 16, 10)
    return (head.cast("decimal(20,0)") % F.lit(partitions)).cast("int")


def topic_partition(stream_type: Column, symbol: Column, partitions: int) -> Column:
    """Partition of a (stream type, symbol) pair; case does not matter.

    An empty or null part would merge different groups, so it fails the query.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    separator = F.decode(F.unhex(F.lit("00")), "UTF-8")
    slot = _digest_slot(
        F.concat(F.lower(stream_type), separator, F.lower(symbol)).cast("binary"), partitions
    )
    blank = (F.coalesce(F.length(stream_type), F.lit(0)) == 0) | (
        F.coalesce(F.length(symbol), F.lit(0)) == 0
    )
    return F.when(
        blank, F.raise_error(F.lit("stream_type and symbol must not be empty")).cast("int")
    ).otherwise(slot)


def audit_partition(stream_type: Column, partitions: int) -> Column:
    """Audit partition: by position for known stream types, else by digest."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    name = F.lower(stream_type)
    known = F.array(*[F.lit(s) for s in AUDIT_STREAM_ORDER])
    place = F.array_position(known, name)
    blank = F.coalesce(F.length(stream_type), F.lit(0)) == 0
    return (
        F.when(blank, F.raise_error(F.lit("stream_type must not be empty")).cast("int"))
        .when(place > 0, ((place - 1) % F.lit(partitions)).cast("int"))
        .otherwise(_digest_slot(name.cast("binary"), partitions))
    )
