"""What several operators of this subpackage need."""

from __future__ import annotations

import weakref
from collections.abc import Iterator

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words: runs of anything but space and the controls 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
BATCH = "4m"
#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
#: Results that a Memory holds, at most twice as many.
MEMORY = 100_000
#: Characters of a word that a ShortMemory does remember.
WORD_CHARS = 32
_memories: list[weakref.ref] = []


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH`` at most, unless the session has a size of its own.

    A task holds batches several times over: in the JVM, on the way, and in each worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).removesuffix("b") == str(64 << 20):  # as it is if nobody sets it
        spark.conf.set(key, BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*columns: Column, seed: int = 0) -> Column:
    """A number in (0, 1) that only the columns and the seed decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def slices(batch, column: str | int, most: int = SLICE_BYTES) -> Iterator:
    """Parts of a record batch with at most ``most`` bytes of text each, or one row."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if held + size > most and at > start:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def word_blocks(data: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists that cover about ``most`` bytes each."""
    if len(data) <= most:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = min(start + most, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end].split()
        start = end


class Memory(dict):
    """A function's results by argument: the newest, and those used since the last change of guard."""

    def __init__(self, function, most: int = MEMORY):
        super().__init__()
        self.function, self.most, self.older = function, most, {}
        _memories.append(weakref.ref(self))

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.function(key)
        return self.keep(key, value)

    def keep(self, key, value):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.older = {}
        self.clear()


class ShortMemory(Memory):
    """Remembers results of short words only, so its size is bounded in bytes."""

    def keep(self, key, value):
        return super().keep(key, value) if len(key) <= WORD_CHARS else value


def only(module: str) -> None:
    """Empties what this worker remembers for other modules: workers go from operator to operator."""
    _memories[:] = [m for m in _memories if m() is not None]
    for memory in [m() for m in _memories]:
        if memory is not None and memory.function.__module__ != module:
            memory.forget()
