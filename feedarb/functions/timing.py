"""Microsecond arithmetic around the one-second tick."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedarb.params import TICK_US


def int_div(value: Column, by: int) -> Column:
    """BIGINT division without a trip through DOUBLE."""
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def next_tick(value_us: Column) -> Column:
    """Smallest whole second not before ``value_us``."""
    return value_us + F.pmod(-value_us, F.lit(TICK_US))


def seconds(value_us: Column) -> Column:
    return value_us / F.lit(1_000_000.0)
