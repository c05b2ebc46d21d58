"""Byte-level BPE encoding and decoding in linear time.

A text is cut into pieces by a pattern and each piece is encoded by itself.  An
Aho-Corasick automaton over the vocabulary (bytes held as Latin-1 characters)
gives the longest token at every position of a piece.  From the left, the longest
token that is compatible with the one before it is taken; where none is left, the
last token is given up and its next shorter prefix is tried.  Two tokens are
compatible if merging their joined bytes leaves just these two, which is remembered.
A sequence whose neighbours are all compatible is what the merges produce, so the
result equals the merge order exactly, and no position is given up twice.

Null texts count as empty; empty texts have no ids.  Ids that are not in the
vocabulary end decoding with an error.  Rows stay where they are: no shuffle.
"""

from __future__ import annotations

import array
import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.llm.shared import Memory, ShortMemory, only, slices

#: Texts that are decoded at a time.
DECODED_ROWS = 256
#: Words with a blank before them that a worker remembers, at most twice as many.
WORDS = 250_000


class BytePairCodec:
    """Encoder and decoder for one table of token ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._find = regex.compile(pattern).findall
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()
        self._parts = Memory(self._last_merge)
        self._compatible = Memory(self._fits)
        self._shorter = Memory(self._next_prefix)
        self._pieces = ShortMemory(self._encode_piece)
        self._words = ShortMemory(self._encode_word)
        self._inner = ShortMemory(lambda word: self._encode_word(" " + word), WORDS)

    def merge(self, data: bytes, never: int = -1) -> list[int]:
        """The plain definition: again and again the neighbours of lowest rank (but ``never``)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            found = [1 << 60 if rank == never else rank for rank in found]
            at = min(range(len(found)), key=found.__getitem__)
            if found[at] == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _last_merge(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or if merges never make it."""
        parts = self.merge(self.token[rank], rank)
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Do the merges of the joined bytes leave just these two tokens (-1: nothing on the left)?

        Goes back in time: the token made later is undone, and each pair that then meets
        at the border must not be one that the merges would have joined before that.
        """
        left, right = pair
        if len(self.token[right]) > 1 and self._parts[right] is None:
            return False
        if left < 0:
            return True
        before = 1 << 60
        while True:
            if self.ranks.get(self.token[left] + self.token[right], before) < before:
                return False
            made = [t if len(self.token[t]) > 1 else -1 for t in (left, right)]
            if made == [-1, -1]:
                return True
            if made[0] > made[1]:
                before, left = left, self._parts[left][1]
            else:  # of equal merges the one on the left comes first
                before, right = right + 1, self._parts[right][0]

    def _next_prefix(self, rank: int) -> int:
        token = self.token[rank]
        for end in range(len(token) - 1, 0, -1):
            if (found := self.ranks.get(token[:end], -1)) >= 0:
                return found
        return -1

    def _encode_piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        return array.array("i", (whole,) if whole is not None else self.backtrack(data)).tobytes()

    def backtrack(self, data: bytes) -> list[int]:
        best = [-1] * len(data)
        for end, (length, rank) in self._automaton.iter(data.decode("latin-1")):
            best[end - length + 1] = rank  # later ends are longer tokens
        lengths, compatible = self._length, self._compatible
        given_up = bytearray(len(data) + 1)
        out: list[int] = []
        at, last, candidate = 0, -1, best[0]
        while at < len(data):
            while candidate >= 0:
                end = at + lengths[candidate]
                if not given_up[end] and compatible[last, candidate]:
                    break
                candidate = self._shorter[candidate]
            if candidate >= 0:
                out.append(candidate)
                at, last = end, candidate
                candidate = best[at] if at < len(data) else -1
            else:
                given_up[at] = 1
                dropped = out.pop()
                at -= lengths[dropped]
                last = out[-1] if out else -1
                candidate = self._shorter[dropped]
        return out

    def _encode_word(self, word: str) -> bytes:
        return b"".join([self._pieces[p] for p in self._find(word)])

    def encode(self, text: str) -> bytes:
        """Token ids as 32-bit integers."""
        if " ".join(text.split()) != text.replace("\n", " "):
            return b"".join(map(self._pieces.__getitem__, self._find(text)))
        # Single blanks and line ends between words: a blank always begins a piece and a
        # line end is one, so the words can be looked up.
        parts: list[bytes] = []
        for at, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            parts.append(self._words["\n" + first if at else first])
            parts.extend(map(self._inner.__getitem__, rest))
        return b"".join(parts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> BytePairCodec:
    """One codec per worker process, file and pattern."""
    return BytePairCodec({token: rank for rank, token in tokens(ranks_path).items()}, pattern)


@functools.lru_cache(maxsize=2)
def tokens(ranks_path: str) -> dict[int, bytes]:
    """Bytes by token id."""
    with open(ranks_path, "rb") as lines:
        return {int(r): base64.b64decode(t) for t, r in map(bytes.split, filter(bytes.strip, lines))}


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of ``text``."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        own = codec(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [own.encode(text.as_py() or "") for text in part.column("text")]
                ends = np.cumsum([0, *map(len, found)]) // 4
                values = np.frombuffer(b"".join(found), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for; null ids: no bytes."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens(ranks_path)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(start, DECODED_ROWS)
                ids = part.column("ids")
                ends = ids.offsets.to_numpy()
                values = ids.values.to_numpy()[ends[0] : ends[-1]].tolist()
                ends = (ends - ends[0]).tolist()
                texts = [b"".join(map(token.__getitem__, values[a:b])) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.mapInArrow(decoded, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, token count and digests of the ids and of the bytes they decode to.

    Each text is encoded, and its ids decoded, by one worker in one pass; decoded bytes stay there.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        own = codec(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [own.encode(text.as_py() or "") for text in part.column("text")]
                sums = [hashlib.sha256(own.decode(memoryview(ids).cast("i").tolist())).hexdigest() for ids in found]
                ends = np.cumsum([0, *map(len, found)]) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(sums, pa.string())], ["doc_id", "ids", "decoded_sha256"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(digested, "doc_id long, ids array<int>, decoded_sha256 string").select(
        "doc_id",
        *["ids"] * with_ids,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "decoded_sha256",
    )
