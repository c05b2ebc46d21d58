"""Shards of nearly equal bytes by best-fit-decreasing bin packing.

Documents of equal text form an indivisible group.  Groups sorted by size enter the fullest
shard that still has room, found in a balanced tree of remaining capacities.  Groups of one
size are alike, so packing takes (size, number of groups) and puts as many at once as fit: the
shard that took the first is still the tightest for the next.  The driver sees one row per
distinct size only; distinct sizes add up to no more than all bytes, so there are
at most sqrt(2 * bytes) of them.  Groups of a size are numbered, by blocks where there are many,
and a shard takes a run of numbers.  A group above an equal share gets a shard of its own.

Null texts have size 8, are a group of their own, and their CRC is that of no bytes.
Repeated rows are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedarb.plans.storage import durable

#: Rows that get their places in a shard, and groups that get their numbers in a size, together, about.
PLACE_ROWS = 10_000
#: Texts with more than one in so many rows are labelled without a shuffle; there are no more of them than that.
HEAVY_TEXTS = 4096


class CapacityTree:
    """Treap of (remaining capacity, shard): insert, and take the least that fits."""

    def __init__(self):
        self._root = None
        self._draw = random.Random(0).random

    def insert(self, capacity: int, shard: int) -> None:
        low, high = self._split(self._root, (capacity, shard))
        self._root = self._merge(self._merge(low, [(capacity, shard), self._draw(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the smallest entry with at least this capacity."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        _, rest = self._split(high, (node[0][0], node[0][1] + 1))
        self._root = self._merge(low, rest)
        return node[0]

    def _split(self, node, key):
        """Entries below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            below, other = self._split(node[3], key)
            node[3] = below
            return node, other
        below, other = self._split(node[2], key)
        node[2] = other
        return below, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit_decreasing(
    classes: Iterable[tuple[int, int]], capacity: int, most: int | None = None
) -> list[tuple[int, int, int]] | None:
    """(size, shard, number of groups) for classes (size, number of groups), in the order they are placed.

    None if that takes more than ``most`` shards.
    """
    tree, opened, dealt = CapacityTree(), 0, []
    for size, count in sorted(classes, reverse=True):
        while count:
            found = tree.take(size)
            if found is None:
                if opened == most or size > capacity:
                    return None
                found = (capacity, opened)
                opened += 1
            taken = min(count, found[0] // size)
            dealt.append((size, found[1], taken))
            tree.insert(found[0] - taken * size, found[1])
            count -= taken
    return dealt


def pack(classes: Iterable[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(size, shard, number of groups) for a fixed number of shards, at the least capacity found."""
    left = sorted(classes)
    total = sum(size * count for size, count in left)
    alone: list[tuple[int, int, int]] = []
    while left and len(alone) < shards - 1 and left[-1][0] * (shards - len(alone)) > total:
        size, count = left.pop()
        alone.append((size, len(alone), 1))
        total -= size
        if count > 1:
            left.append((size, count - 1))
    bins = shards - len(alone)
    least = max(-(-total // bins), left[-1][0] if left else 0)
    step = 0
    while (dealt := best_fit_decreasing(left, least + (least * step >> 14), bins)) is None:
        step = 2 * step + 1
    return alone + [(size, len(alone) + shard, count) for size, shard, count in dealt]


def _numbered(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds ``number`` from 0 among the groups of a size."""
    many = classes.where(F.col("groups") > PLACE_ROWS)
    many = many.select("size", F.ceil(F.col("groups") / PLACE_ROWS).alias("blocks"))
    placed = groups.join(many, "size", "left")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("text_hash"), F.coalesce("blocks", F.lit(1).cast("long")))).drop("blocks")
    before = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("size", "block").count()
    starts = starts.select("size", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy("size", "block").orderBy("text_hash"))
    return (
        placed.withColumn("inner", inner)
        .join(starts, ["size", "block"])
        .withColumn("number", F.col("start") + F.col("inner") - 1)
        .drop("block", "inner", "start")
    )


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id``, ``size`` (bytes and 8), ``text_crc32``, ``shard`` and ``slot`` within it from 0."""
    spark = docs.sparkSession
    text = F.col("text")
    rows = durable(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "texts",
    )
    count = rows.count()
    groups = durable(rows.groupBy("text_hash").agg(F.sum("size").alias("size"), F.count("*").alias("copies")), "groups")
    classes = durable(groups.groupBy("size").agg(F.count("*").alias("groups")), "sizes")
    runs, following = [], {}
    for size, shard, number in pack([tuple(r) for r in classes.select("size", "groups").collect()], shards):
        first = following.get(size, 0)
        following[size] = first + number
        runs.append((size, first, first + number, shard))
    dealt = spark.createDataFrame(runs, "size long, first long, end long, shard int")
    labels = durable(
        _numbered(groups, classes)
        .join(dealt, "size")
        .where("number >= first and number < end")
        .select("text_hash", "copies", "shard"),
        "labels",
    )
    heavy = F.col("copies") * HEAVY_TEXTS > count
    few = labels.where(heavy).select("text_hash", F.col("shard").alias("own"))
    marked = rows.join(F.broadcast(few), "text_hash", "left")
    rows = (
        marked.where("own is not null")
        .withColumnRenamed("own", "shard")
        .unionByName(marked.where("own is null").drop("own").join(labels.where(~heavy).drop("copies"), "text_hash"))
    )

    blocks = max(1, count // (shards * PLACE_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").count()
    starts = starts.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_hash"))
    return (
        rows.withColumn("inner", inner)
        .join(starts, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("inner") - 1).alias("slot"))
    )
