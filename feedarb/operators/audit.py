"""The audit log: four kinds of JSON messages on one ordered feed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedarb.functions.json import last_of_repeated, member, members, typed_members
from feedarb.functions.keys import audit_partition
from feedarb.sources.landing import GROUP

SCHEMA_VERSION = 1

# The wire format.  Members in wire order with their types; those in
# OPTIONAL may be absent, all others must be there (null allowed).
WIRE: dict[str, dict[str, str]] = {
    "tally": {
        "stream_type": "string",
        "symbol": "string",
        "window_start": "double",
        "emitted_at": "double",
        "counts": "map<string,bigint>",
        "total_events": "bigint",
        "correlation_id": "string",
    },
    "verdict": {
        "stream_type": "string",
        "symbol": "string",
        "window_start": "double",
        "window_end": "double",
        "slowest_source_id": "string",
        "counts": "map<string,bigint>",
        "total_events": "bigint",
        "sources_seen": "bigint",
        "reason": "string",
        "correlation_id": "string",
    },
    "gate_stalled": {
        "stream_type": "string",
        "symbol": "string",
        "sources_confirmed": "bigint",
        "sources_expected": "bigint",
        "stalled_for_seconds": "double",
        "ignored_sources": "array<string>",
        "emitted_at": "double",
    },
    "kill_confirmed": {
        "stream_type": "string",
        "symbol": "string",
        "source_id": "string",
        "instance_id": "string",
        "terminated_at": "double",
        "correlation_id": "string",
    },
}
OPTIONAL = {
    "tally": ("correlation_id",),
    "verdict": ("reason", "correlation_id"),
    "gate_stalled": (),
    "kill_confirmed": ("instance_id", "correlation_id"),
}

_MEMBERS: dict[str, str] = {}
for _fields in WIRE.values():
    _MEMBERS.update(_fields)

# Epoch seconds are written as plain decimals, never in exponent form.
_WIRE_SECONDS = "decimal(17,6)"


def wire_seconds(at_us: Column) -> Column:
    return (at_us.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")).cast(
        _WIRE_SECONDS
    )


def encode(messages: DataFrame, kind: str, partitions: int) -> DataFrame:
    """Messages of one kind as sink rows: key, JSON value, partition.

    Absent optional columns are written as nulls; times may come as DOUBLE or as
    ``wire_seconds``.
    """
    members = [
        (F.col(name) if name in messages.columns else F.lit(None).cast(dtype)).alias(name)
        for name, dtype in WIRE[kind].items()
    ]
    body = F.struct(
        F.lit(kind).alias("type"), F.lit(SCHEMA_VERSION).alias("schema_version"), *members
    )
    return messages.select(
        F.col("stream_type").cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        audit_partition(F.col("stream_type"), partitions).alias("partition"),
    )


def encode_all(messages: Mapping[str, DataFrame], partitions: int) -> DataFrame:
    """One log out of several kinds of messages."""
    parts = [encode(df, kind, partitions) for kind, df in messages.items()]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


# Strings that the reader takes for doubles.
_NUMBER_NAMES = ("NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF")


def _status() -> Column:
    """Verdict on one message from its text, its ``_keys``, ``_kind``, ``_version`` and ``_shape``."""
    kind, text, number = F.col("_kind"), F.col("_text"), F.col("_shape.schema_version")
    truth = F.col("_version").isin("true", "false") & typed_members(text, "schema_version boolean")["schema_version"].isNotNull()
    comparable = (
        ~F.array_contains("_keys", "schema_version")
        | (number.isNotNull() & ~F.col("_version").isin(*_NUMBER_NAMES))
        | F.coalesce(truth, F.lit(False))
    )
    nested = (
        typed_members(text, "type array<string>")["type"].isNotNull()
        | typed_members(text, "type map<string,string>")["type"].isNotNull()
    )
    incomplete = F.lit(False)
    for name, fields in WIRE.items():
        required = [F.lit(f) for f in fields if f not in OPTIONAL[name]]
        lacking = F.size(F.array_except(F.array(*required), F.col("_keys"))) > 0
        if "counts" in fields:
            lacking = lacking | F.col("_shape.counts").isNull()
        if "ignored_sources" in fields:
            lacking = lacking | F.col("_shape.ignored_sources").isNull()
        incomplete = F.when(kind == name, lacking).otherwise(incomplete)
    return (
        F.when(F.col("_keys").isNull() | kind.isNull(), "malformed")
        .when(~comparable, "malformed")
        .when(F.coalesce(number > SCHEMA_VERSION, F.lit(False)) & ~F.isnan(number), "unrecognised")
        .when(~kind.isin(*WIRE), F.when(nested, "malformed").otherwise("unrecognised"))
        .when(F.coalesce(incomplete, F.lit(True)), "malformed")
        .otherwise("ok")
    )


def _computed_once(**columns: Column) -> Column:
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))


def decode(log: DataFrame) -> DataFrame:
    """Classify and parse log messages (``value`` bytes; other columns are kept).

    ``decode_status`` is ok, unrecognised (newer version or unknown type) or
    malformed.  Only good messages have typed members.
    """
    ok = F.col("decode_status") == "ok"
    schema = ", ".join(f"{name} {dtype}" for name, dtype in _MEMBERS.items())
    text = F.col("_text")
    # Each step hands on what it found.  The one-row generators keep later filters from
    # repeating a step's expressions.
    found = log.withColumn("_text", F.try_validate_utf8(F.col("value").cast("string"))).select(
        *log.columns, "_text", _computed_once(_members=members(text))
    )
    kinds = found.select(
        *log.columns,
        "_text",
        _computed_once(
            _keys=F.transform("_members", lambda e: e["key"]),
            _kind=member(F.col("_members"), "type"),
            _version=member(F.col("_members"), "schema_version"),
            _shape=typed_members(text, "schema_version double, counts map<string,string>, ignored_sources array<string>"),
        ),
    )
    read = kinds.select(
        *log.columns, "_text", "_kind", _computed_once(decode_status=_status())
    ).select(
        *log.columns,
        "decode_status",
        F.when(ok, F.col("_kind")).alias("message_type"),
        _computed_once(_body=F.when(ok, typed_members(text, schema))),
    )
    return read.select(
        *log.columns,
        "decode_status",
        "message_type",
        *[
            F.when(
                F.col("message_type").isin(*[k for k, f in WIRE.items() if name in f]),
                last_of_repeated(F.col("_body")[name]) if name == "counts" else F.col("_body")[name],
            ).alias(name)
            for name in _MEMBERS
        ],
    ).withColumn(
        "is_actionable",
        F.when(F.col("message_type") == "verdict", F.col("slowest_source_id").isNotNull()),
    )


def of_type(decoded: DataFrame, kind: str) -> DataFrame:
    """The messages of one kind with just their own members."""
    place = [c for c in ("partition", "offset") if c in decoded.columns]
    extra = ["is_actionable"] if kind == "verdict" else []
    return decoded.where(F.col("message_type") == kind).select(*place, *WIRE[kind], *extra)


def confirmations_before_verdict(decoded: DataFrame) -> DataFrame:
    """Confirmations with ``preceded``: whether a verdict named the source earlier.

    One stream type is one partition, so the offset orders cause and effect.
    """
    first_named = (
        of_type(decoded, "verdict")
        .where("is_actionable")
        .groupBy(*GROUP, F.col("slowest_source_id").alias("source_id"))
        .agg(F.min("offset").alias("_named"))
    )
    return (
        of_type(decoded, "kill_confirmed")
        .join(first_named, [*GROUP, "source_id"], "left")
        .withColumn("preceded", F.coalesce(F.col("_named") < F.col("offset"), F.lit(False)))
        .select(*GROUP, "source_id", "partition", "offset", "preceded")
    )
