"""Exact top-k by inner product on a bit-sliced index.

Vectors are quantised to integers.  A task holds a block of candidates as bit slices: for each
dimension and bit one bitmap over the block's rows, kept as a Python integer.  For a query the
slices of each dimension are added, shifted by the digits of the query's component, with
carry-save adders on bitmaps; the result are the slices of all scores.  From the most
significant slice downward, rows that are surely among the best are set apart and rows level
with the boundary are kept, until the number wanted is reached; rows still level then are
taken in order of their id.  Nothing is rounded, so the result is exact.

Queries are dealt to chunks and candidates to ``parts``; each part of each chunk is a stream
of its queries first, then its candidates block by block, and gives k rows per query at most.
Vectors that are null or hold null or non-finite components take no part, nor do rows without
an id.  Missing components of shorter vectors count as zero.  Quantised components are whole
numbers of any size, and scores are exact.  A score that a long does not hold ends the query with an
error where it is among the best of a part.  A row with the query's own id is never its candidate;
queries that share an id share its k rows, and a candidate that comes twice counts twice.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 1024
#: Doubles from here on are whole numbers.
WHOLE = float(1 << 53)
#: Candidates in a block, queries in a chunk.
BLOCK, CHUNK = 8192, 4096


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of each component, x a double, as array<double>; null if the vector takes no part."""
    valid = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))

    def floor(x: Column) -> Column:
        return F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)

    return F.when(valid, F.transform(vector, lambda x: floor(x.cast("double") * SCALE)))


def integers(vectors: list[list[float]]) -> np.ndarray:
    """One row of whole numbers per vector, filled up with 0: int64, or Python's where that is too small."""
    values = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for at, vector in enumerate(vectors):
        values[at, : len(vector)] = vector
    if np.abs(values).max(initial=0) < 1 << 62:  # so that differences fit as well
        return values.astype(np.int64)
    if not np.isfinite(values).all():
        raise ValueError("a component times the scale is beyond all doubles: no long holds its scores")
    return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object)


def _sum_slices(slices: dict[int, list[int]]) -> list[int]:
    """Slices of the sum, by place, of bitmaps that count 2**place each."""
    out = []
    place = 0
    last = max(slices, default=-1)
    while place <= last:
        maps = slices.get(place, [])
        above = slices.setdefault(place + 1, [])
        while len(maps) > 2:
            a, b, c = maps.pop(), maps.pop(), maps.pop()
            half = a ^ b
            maps.append(half ^ c)
            above.append(a & b | half & c)
        if len(maps) == 2:
            a, b = maps
            maps = [a ^ b]
            above.append(a & b)
        out.append(maps[0] if maps else 0)
        if above:
            last = max(last, place + 1)
        place += 1
    return out


class BitSlices:
    """Candidates of one block, in order of id, as bitmaps by dimension and bit."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        """``values``: one row of integers per candidate."""
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.all = (1 << len(ids)) - 1
        self.lows = values.min(axis=0).tolist() if len(ids) else []
        self.columns: list[list[int]] = []
        for low, column in zip(self.lows, values.T):
            own = column - low  # from 0
            bits = int(own.max()).bit_length()
            packed = (np.packbits((own >> bit & 1).astype(np.uint8), bitorder="little") for bit in range(bits))
            self.columns.append([int.from_bytes(p.tobytes(), "little") for p in packed])

    def scores(self, query: list[int]) -> tuple[list[int], int]:
        """Slices of score - base for all rows, and the base.

        A component is written in digits -1, 0 and 1.  A slice s that counts negatively is
        added as its complement: -s is (all ones - s) - 1.
        """
        slices: dict[int, list[int]] = {}
        base = 0
        for value, low, column in zip(query, self.lows, self.columns):
            base += value * low
            place = 0
            while value:
                if value & 1:
                    digit = 2 - (value & 3)
                    value -= digit
                    for bit, bitmap in enumerate(column, place):
                        if digit > 0:
                            slices.setdefault(bit, []).append(bitmap)
                        else:
                            slices.setdefault(bit, []).append(bitmap ^ self.all)
                            base -= 1 << bit
                value >>= 1
                place += 1
        return _sum_slices(slices), base

    def best(self, query: list[int], own_id: int | None, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k highest scores, ties to smaller ids."""
        slices, base = self.scores(query)
        level = self.all
        at = int(np.searchsorted(self.ids, own_id)) if own_id is not None else len(self.ids)
        while at < len(self.ids) and self.ids[at] == own_id:
            level &= ~(1 << at)
            at += 1
        sure = 0
        for bitmap in reversed(slices):
            ahead = level & bitmap
            if not ahead:
                continue
            count = (sure | ahead).bit_count()
            if count > k:
                level = ahead
            else:
                sure |= ahead
                level &= ~bitmap
                if count == k:
                    level = 0
                    break
        chosen = []
        while sure:
            bit = sure & -sure
            chosen.append(bit.bit_length() - 1)
            sure ^= bit
        while level and len(chosen) < k:
            bit = level & -level
            chosen.append(bit.bit_length() - 1)
            level ^= bit
        return [
            (base + sum((bitmap >> row & 1) << place for place, bitmap in enumerate(slices)), int(self.ids[row]))
            for row in chosen
        ]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; inputs have vec_id and vector (``quantised``)."""
    queries = queries.where("vec_id is not null and vector is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    candidates = candidates.where("vec_id is not null and vector is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    spark = queries.sparkSession
    chunks = max(1, -(-queries.count() // CHUNK))
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-candidates.count() // (BLOCK // 4))))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    chunk = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(chunks)).cast("int")
    asked = queries.select(
        chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), "vec_id", "vector"
    )
    offered = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), part.alias("part"), F.lit(1).alias("kind"), "vec_id", "vector"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[int, int] | None = None
        asking: list[tuple[int, list[int]]] = []
        found: list[list[tuple[int, int]]] = []
        waiting: list[tuple[int, list[int]]] = []

        def block() -> None:
            if not waiting:
                return
            index = BitSlices(np.array([i for i, _ in waiting], np.int64), integers([v for _, v in waiting]))
            waiting.clear()
            for at, (query_id, vector) in enumerate(asking):
                best = found[at] + index.best(vector, query_id, k)
                found[at] = heapq.nsmallest(k, best, key=lambda x: (-x[0], x[1]))

        def result() -> Iterator[pa.RecordBatch]:
            block()
            rows = [(q, i, s) for (q, _), best in zip(asking, found) for s, i in best]
            if beyond := next((r for r in rows if not -(1 << 63) <= r[2] < 1 << 63), None):
                raise ValueError(f"no long holds the score of query {beyond[0]} and vector {beyond[1]}")
            asking.clear()
            found.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["query_id", "vec_id", "score"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("chunk", "part", "kind", "vec_id", "vector"))
            for chunk, part, kind, vec_id, vector in zip(*columns):
                if (chunk, part) != own:
                    yield from result()
                    own = (chunk, part)
                if kind == 0:
                    asking.append((vec_id, integers([vector])[0].tolist()))
                    found.append([])
                elif asking:
                    waiting.append((vec_id, vector))
                    if len(waiting) == BLOCK:
                        block()
        yield from result()

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.union(offered)
        .repartition("chunk", "part")
        .sortWithinPartitions("chunk", "part", "kind")
        .mapInArrow(search, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
