"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Texts that are equal up to a few words have 64-bit fingerprints that differ in a few bits.
Distinct fingerprints are dealt to tasks so that any two within the distance meet: they
agree in at least one of ``distance + 1`` bands of bits.  In each group a task builds a
:class:`GrayIndex` and walks it from fingerprint to fingerprint, giving one edge for each
newly reached one: as many edges as fingerprints at most, and the same components as from
all pairs.  A group of very many fingerprints is dealt once more by bands of the bits left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedarb.llm.components import components
from feedarb.llm.shared import word_blocks
from feedarb.plans.storage import durable

SEED = 42
#: Fingerprints of one band's value that a task takes; more are dealt by a second band.
GROUP = 50_000


def fingerprint(text: str | None, size: int = 3) -> int:
    """Bits set in over half of the XXH64 hashes of all word shingles; 0 without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    total = 0
    carried: list[bytes] = []
    for words in word_blocks((text or "").encode().lower()):
        words = carried + words
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
        hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
        total += len(hashes)
        carried = words[-(size - 1) :] if size > 1 else []
    if not total:
        return digest(b" ".join(carried), SEED) if carried else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint of ``text`` as a signed long."""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            prints = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "fp"])

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(taken, "doc_id long, fp long")


class GrayIndex:
    """Fingerprints in Gray order under a tree of shared bits.

    Neighbours in Gray order differ in few bits, so runs of ``fan`` of them share most:
    a node has the bits that all below it share and no ancestor has.  A search adds up
    the differences in these bits on its way down and leaves out all below a node where
    they exceed the distance.  Reached fingerprints are taken out, and so are nodes
    without any left.
    """

    def __init__(self, prints: np.ndarray, fan: int = 8):
        rank = prints.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        self.prints = prints[np.argsort(rank, kind="stable")]
        self.fan = fan
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        mask = np.full(len(prints), ~np.uint64(0))
        bits, left = self.prints, np.ones(len(prints), np.int64)
        while len(bits) > fan:
            at = np.arange(0, len(bits), fan)
            spread = np.bitwise_or.reduceat(bits ^ np.repeat(bits[at], fan)[: len(bits)], at)
            over = np.bitwise_and.reduceat(mask, at) & ~spread
            self.levels.append((bits, mask & ~np.repeat(over, fan)[: len(bits)], left))
            bits, mask, left = bits[at], over, np.add.reduceat(left, at)
        self.levels.append((bits, mask, left))

    def take_out(self, places: np.ndarray) -> None:
        for _, _, left in self.levels:
            np.subtract.at(left, places, 1)
            places = places // self.fan

    def search(self, value: np.uint64, distance: int) -> np.ndarray:
        """Places of the fingerprints left within the distance."""
        bits, mask, left = self.levels[-1]
        at = np.arange(len(bits))
        far = np.zeros(len(bits), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            bits, mask, left = self.levels[depth]
            far = far + np.bitwise_count((bits[at] ^ value) & mask[at])
            stays = (far <= distance) & (left[at] > 0)
            at, far = at[stays], far[stays]
            if depth and len(at):
                below = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                far = np.repeat(far, self.fan)
                there = below < len(self.levels[depth - 1][0])
                at, far = below[there], far[there]
        return at


def forest(prints: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Edges that join the distinct fingerprints within the distance, none to spare."""
    index = GrayIndex(prints)
    reached = np.zeros(len(prints), bool)
    for start in range(len(prints)):
        if reached[start]:
            continue
        pending = [start]
        reached[start] = True
        index.take_out(np.array(pending))
        while pending:
            value = index.prints[pending.pop()]
            found = index.search(value, distance)
            if len(found):
                reached[found] = True
                index.take_out(found)
                pending += found.tolist()
                for other in index.prints[found].tolist():
                    yield int(value), other


def _band(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))


def links(prints: DataFrame, distance: int = 2, group: int = GROUP) -> DataFrame:
    """Edges ``a``, ``b`` whose components are those of all ``fp`` within the distance.

    ``fp`` must be distinct and not null.
    """
    cuts = [64 * i // (distance + 1) for i in range(distance + 2)]
    bands = list(zip(cuts, cuts[1:]))
    fp = F.col("fp")
    keys = prints.select(
        "fp",
        F.posexplode(F.array(*(_band(fp, a, b - a) for a, b in bands))).alias("band", "key"),
    ).withColumns({"part": F.lit(-1), "inner": F.lit(0).cast("long")})
    large = keys.groupBy("band", "key").count().where(F.col("count") > group)
    if not large.isEmpty():
        keys = keys.join(durable(large.select("band", "key", F.lit(True).alias("large")), "large"), ["band", "key"], "left")
        split = [
            F.struct(F.lit(3 * i + j).alias("part"), _band(fp, a, b - a).alias("inner"))
            for i, own in enumerate(bands)
            for j, (a, b) in enumerate(_rest(bands, own, distance + 1))
        ]
        by_band = F.create_map(
            *(
                x
                for i in range(len(bands))
                for x in (F.lit(i), F.array(*split[i * len(split) // len(bands) : (i + 1) * len(split) // len(bands)]))
            )
        )
        whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("inner")))
        keys = keys.select(
            "fp", "band", "key", F.explode(F.when(F.col("large"), by_band[F.col("band")]).otherwise(whole)).alias("x")
        ).select("fp", "band", "key", "x.part", "x.inner")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(values: np.ndarray) -> pa.RecordBatch | None:
            found = list(forest(values.view(np.uint64), distance)) if len(values) > 1 else []
            if not found:
                return None
            pairs = np.array(found, np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held, own = [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "key", "part", "inner")]
            prints = batch.column("fp").to_numpy(zero_copy_only=False)
            changes = np.zeros(len(prints), bool)
            for column in columns:
                changes[1:] |= column[1:] != column[:-1]
            starts = [0, *np.flatnonzero(changes).tolist(), len(prints)]
            for first, end in zip(starts, starts[1:]):
                if first == end:
                    continue
                group_of = tuple(int(c[first]) for c in columns)
                if group_of != own and held:
                    if (out := edges(np.concatenate(held))) is not None:
                        yield out
                    held = []
                own = group_of
                held.append(prints[first:end])
        if held and (out := edges(np.concatenate(held))) is not None:
            yield out

    order = ["band", "key", "part", "inner"]
    return keys.repartition(*order).sortWithinPartitions(*order).mapInArrow(joined, "a long, b long")


def _rest(bands: list[tuple[int, int]], own: tuple[int, int], parts: int) -> list[tuple[int, int]]:
    """Bands other than ``own``, cut so that there are at least ``parts``."""
    others = [b for b in bands if b != own]
    while len(others) < parts:
        widest = max(others, key=lambda b: b[1] - b[0])
        middle = (widest[0] + widest[1]) // 2
        others.remove(widest)
        others += [(widest[0], middle), (middle, widest[1])]
    return sorted(others)


def near_duplicates(docs: DataFrame, distance: int = 2, size: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest doc_id reachable by links.

    One row per row of ``docs``.  Null and empty texts have fingerprint 0 and are linked
    like any other; ids that are null or come twice share their text's component, and a
    component without any id has a null one.
    """
    prints = durable(fingerprints(docs, size), "fingerprints")
    distinct = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    joined = components(links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp")
    named = joined.join(distinct, "fp")
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    labels = named.join(least, "component").select("fp", "least")
    labels = distinct.join(labels, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
