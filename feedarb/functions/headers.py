"""Lookups in message headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def header_value(headers: Column, name: str) -> Column:
    """Text of the first header called ``name``; null if absent, empty or not UTF-8."""
    return F.nullif(text_of(header_bytes(headers, name)), F.lit(""))


def header_bytes(headers: Column, name: str) -> Column:
    # By position, as plain array functions: a filter with a lambda is interpreted row by row.
    place = F.array_position(headers["key"], name).cast("int")
    return F.get(headers["value"], place - 1)


def text_of(value: Column) -> Column:
    """Bytes as text; null where they are not UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def is_broken_text(value: Column) -> Column:
    return value.isNotNull() & text_of(value).isNull()
