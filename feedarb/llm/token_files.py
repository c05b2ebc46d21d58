"""Token ids in grammar-compressed files.

Documents are range-partitioned and sorted by id, encoded, and written as blocks: rows of
a Parquet table, so that any store Spark writes to will do.  A block holds the ids of whole
consecutive documents as a Re-Pair grammar: frequent pairs of neighbours are replaced by
nonterminals again and again; ``symbols`` is what is left, ``rules`` has the two symbols of
each nonterminal, ``rule_lengths`` the ids each expands to.  With the lengths, any range of
ids is decoded without the rest (:meth:`Grammar.between`).

Each turn replaces all pairs above a count whose left symbol is in one half of the alphabet
and whose right symbol is in the other half.  Such pairs never overlap, so a turn is a few
array operations; the halves change and the least count sinks from turn to turn.  At the last
count, left and right symbols are taken from the pairs that reach it, until none does.

Null texts count as empty; each document ends with ``end_id``.  Rows of equal id are
ordered by text, null ids come first.  A document longer than a block makes a longer block.
"""

from __future__ import annotations

import functools
import os
import string
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedarb.llm.shared import WORD_CHARS, Memory, slices

BLOCK_SCHEMA = (
    "part int, block int, start long, n_tokens long, base long, doc_ids array<long>, "
    "lengths array<long>, symbols binary, rules binary, rule_lengths binary"
)
#: Ids in a block, at least.
BLOCK_TOKENS = 1 << 20
#: Words that a worker remembers, at most twice as many.
WORDS = 700_000
#: Words whose ids are put in order at a time.
GATHERED_WORDS = 1 << 20
#: Letters that normalization only sets in lower case, one by one.
_PLAIN = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$"


@dataclass
class Grammar:
    """Symbols below ``base`` are ids; ``base + k`` stands for the two symbols of rule k."""

    base: int
    symbols: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray

    def _sizes(self) -> np.ndarray:
        sizes = np.ones(len(self.symbols), np.int64)
        inner = self.symbols >= self.base
        sizes[inner] = self.lengths[self.symbols[inner] - self.base]
        return sizes

    def decode(self) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        base = self.base
        own = np.arange(base, dtype="<u4").tobytes()
        made: list[bytes] = []
        for left, right in self.rules.tolist():
            first = own[4 * left : 4 * left + 4] if left < base else made[left - base]
            made.append(first + (own[4 * right : 4 * right + 4] if right < base else made[right - base]))
        table = np.frombuffer(own + b"".join(made), "<u4")
        sizes = np.concatenate([np.ones(base, np.int64), self.lengths])
        starts = np.cumsum(sizes) - sizes
        each = sizes[self.symbols]
        before = np.cumsum(each) - each
        places = np.arange(each.sum()) + np.repeat(starts[self.symbols] - before, each)
        return table[places].tobytes()

    def between(self, first: int, end: int) -> list[int]:
        """The ids at positions ``first`` to ``end - 1``; only what covers them is expanded."""
        ends = np.cumsum(self._sizes())
        out: list[int] = []
        if first >= end or not len(ends):
            return out
        at = int(np.searchsorted(ends, first, side="right"))
        place = int(ends[at - 1]) if at else 0
        while at < len(self.symbols) and place < end:
            pending = [int(self.symbols[at])]
            while pending and place < end:
                symbol = pending.pop()
                size = 1 if symbol < self.base else int(self.lengths[symbol - self.base])
                if place + size <= first:
                    place += size
                elif symbol < self.base:
                    out.append(symbol)
                    place += 1
                else:
                    left, right = self.rules[symbol - self.base].tolist()
                    pending += [right, left]
            at += 1
        return out


def _equal(seq: np.ndarray) -> np.ndarray:
    """Places of left symbols of equal pairs, every other one of a run."""
    at = np.flatnonzero(seq[:-1] == seq[1:])
    opens = np.ones(len(at), bool)
    opens[1:] = np.diff(at) > 1
    return at[(at - np.maximum.accumulate(np.where(opens, at, 0))) % 2 == 0]


def _heads(seq: np.ndarray, turn: int) -> np.ndarray:
    """Places of left symbols of pairs that don't overlap.

    Of each three turns two take pairs from one half of the alphabet to the other and
    back; the third takes equal symbols, every other one of a run.
    """
    kind = seq.dtype.type
    if turn % 3 < 2:
        half = (seq * kind(0x9E3779B1) >> kind(31 - turn // 3 * 7 % 32)) & kind(1) == turn % 3
        return np.flatnonzero(half[:-1] & ~half[1:])
    return _equal(seq)


def _frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """What comes ``least`` times or more, in order, with counts; the rest is not made a list of."""
    ranked = np.sort(pairs)
    far = ranked[least - 1 :]
    found = far[far == ranked[: len(far)]]
    if len(found):
        found = found[np.concatenate([[True], found[1:] != found[:-1]])]
    return found, np.searchsorted(ranked, found, "right") - np.searchsorted(ranked, found)


def _last_heads(seq: np.ndarray, least: int, shift: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_heads`, with the most frequent pairs first, and all pairs that come ``least`` times.

    ``ends`` has 1 for symbols that can be the left ones of such pairs, 2 for right ones, 3 for both.
    No heads if there is no such pair.
    """
    kind = seq.dtype.type
    marks = np.take(ends, seq)
    some = np.flatnonzero(marks[:-1] & 1 & marks[1:] >> 1)
    firsts, seconds = seq[some], seq[some + 1]
    found, counts = _frequent(firsts << kind(shift) | seconds, least)
    ranked = found[np.argsort(-counts, kind="stable")]
    left, right = (ranked >> kind(shift)).tolist(), (ranked & kind((1 << shift) - 1)).tolist()
    twice = _equal(seq)
    runs, counts = np.unique(seq[twice], return_counts=True)
    runs = set(runs[counts >= least].tolist())
    lefts: set[int] = set()
    rights: set[int] = set()
    equals: set[int] = set()
    for first, second in zip(left, right):
        if first == second:
            if first in runs and first not in lefts and first not in rights:
                equals.add(first)
        elif not (first in rights or second in lefts or first in equals or second in equals):
            lefts.add(first)
            rights.add(second)
    sides = np.zeros((3, len(ends)), bool)
    for side, symbols in zip(sides, (lefts, rights, equals)):
        side[list(symbols)] = True
    heads = some[np.take(sides[0], firsts) & np.take(sides[1], seconds)]
    return np.sort(np.concatenate([heads, twice[sides[2, seq[twice]]]])), found


def compress(ids: np.ndarray, base: int, least: int = 8, most_rules: int | None = None) -> Grammar:
    """Re-Pair grammar of ids below ``base``; it ends when no pair comes ``least`` times or with ``most_rules``.

    Without ``most_rules`` as many rules are made as keep symbols in 16 bits, or 65,536
    where ids leave too little of that.
    """
    if most_rules is None:
        most_rules = (1 << 16) - base if base <= 60_000 else 1 << 16
    kind, shift = (np.uint32, 16) if base + most_rules <= 1 << 16 else (np.uint64, 32)
    seq = ids.astype(kind)
    rules: list[np.ndarray] = []
    sizes = np.ones(base, np.int64)
    made = turn = 0
    ends = None
    count = max(least, len(ids) >> 9)
    while made < most_rules and len(seq) > 1:
        if count > least:
            heads = _heads(seq, turn)
        else:
            if ends is None:
                ends = np.where(np.bincount(seq, minlength=base + made) >= least, np.uint8(3), np.uint8(0))
            heads, found = _last_heads(seq, least, shift, ends)
            if not len(heads):
                break
        pairs = seq[heads] << kind(shift) | seq[heads + 1]
        chosen, counts = _frequent(pairs, count)
        if len(chosen) > most_rules - made:
            chosen = np.sort(chosen[np.argsort(-counts, kind="stable")[: most_rules - made]])
        if len(chosen):
            parts = np.stack([chosen >> kind(shift), chosen & kind((1 << shift) - 1)], axis=1)
            likely = np.zeros((2, base + made), bool)
            likely[0, parts[:, 0]] = likely[1, parts[:, 1]] = True
            some = np.take(likely[0], seq[heads]) & np.take(likely[1], seq[heads + 1])
            heads, pairs = heads[some], pairs[some]
            place = np.minimum(np.searchsorted(chosen, pairs), len(chosen) - 1)
            hit = chosen[place] == pairs
            heads, place = heads[hit], place[hit]
            seq[heads] = (base + made + place).astype(kind)
            keep = np.ones(len(seq), bool)
            keep[heads + 1] = False
            seq = seq[keep]
            rules.append(parts)
            sizes = np.concatenate([sizes, sizes[parts].sum(axis=1)])
            if ends is not None:
                # Pairs of older symbols only get rarer.
                ends = np.zeros(len(sizes), np.uint8)
                ends[found >> kind(shift)] = 1
                ends[found & kind((1 << shift) - 1)] |= 2
                ends[base + made :] = 3
            made += len(chosen)
        turn += 1
        if turn % 3 == 0:
            count = max(least, count >> 4)
    table = np.concatenate(rules).astype(np.int64) if rules else np.zeros((0, 2), np.int64)
    return Grammar(base, seq.astype(np.int64), table, sizes[base:])


class WordEncoder:
    """A tokenizer of the tokenizers library that drops white space, with words remembered.

    White space separates pieces and is dropped, so the ids of a text are those of its
    words in order, and only distinct words are looked up.  Words of plain Latin letters are
    encoded many in one call, without the signs behind them, and cut apart at the tokens that
    end a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self._ends = np.zeros(self.size, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # The same merges for words that are prepared already: plain ones, in lower case, a sign for each byte.
        self._bare = Tokenizer(self.tokenizer.model)
        # Signs for the bytes of plain words that are not the byte itself.
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = "".join(c for c in map(chr, range(128, 256)) if c.isalpha() and c == c.lower())
        pairs = zip(letters.encode().decode("latin-1"), signs.pre_tokenize_str(letters)[0][0])
        self._signs = {byte: sign for byte, sign in pairs if byte != sign}
        self._known = WordMemory(self._by_library, WORDS)

    def _by_library(self, words: list[str]) -> list[bytes]:
        """Ids of each word, whatever it holds."""
        return [
            np.array(found.ids, "<u4").tobytes()
            for at in range(0, len(words), 256)
            for found in self.tokenizer.encode_batch_fast(words[at : at + 256], add_special_tokens=False)
        ]

    def _in_bulk(self, words: list[str]) -> list[bytes]:
        """Ids of each word; all are plain and in lower case."""
        out: list[bytes] = []
        for at in range(0, len(words), 512):
            some = words[at : at + 512]
            signs = " ".join(some).encode().decode("latin-1")
            for byte, sign in self._signs.items():
                signs = signs.replace(byte, sign)
            signs = [signs.split(" ")]
            found = self._bare.encode_batch_fast(signs, is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
            if len(ends) == len(some):
                data = ids.tobytes()
                out += [data[start:end] for start, end in zip([0, *ends], ends)]
            else:
                out += self._by_library(some)
        return out

    def _learned(self, words: list[str]) -> list[bytes]:
        """Ids of words not known yet."""
        cores = pc.ascii_rtrim(pa.array(words, pa.large_string()), string.punctuation)
        plain = pc.match_substring_regex(cores, _PLAIN).to_numpy(zero_copy_only=False)
        out = [b""] * len(words)
        others = np.flatnonzero(~plain).tolist()
        for at, data in zip(others, self._by_library([words[at] for at in others])):
            out[at] = data
        lower = pc.utf8_lower(cores.filter(pa.array(plain))).dictionary_encode()
        ids = self._known.of(_strings(lower.dictionary), self._in_bulk)
        sizes = pc.utf8_length(cores).to_numpy()[plain].tolist()
        tails: dict[str, bytes] = {"": b""}
        for at, core, size in zip(np.flatnonzero(plain).tolist(), lower.indices.to_numpy().tolist(), sizes):
            tail = words[at][size:]
            if tail not in tails:
                tails[tail] = self._by_library([tail])[0]
            out[at] = ids[core] + tails[tail]
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        return self._known.of(words, self._learned)

    def learn(self, words: set[str]) -> None:
        """Remembers words, those not known yet in bulk."""
        self._ids(list(words))

    def encode(self, words: list[str]) -> bytes:
        """Ids of words in order, as little-endian unsigned 32-bit integers."""
        distinct = list(dict.fromkeys(words))
        known = dict(zip(distinct, self._ids(distinct)))
        return b"".join(map(known.__getitem__, words))

    def encode_texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, null ones as empty, ``end_id`` behind each; and how many each has."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        known = self._ids(_strings(words.dictionary))
        known.append(np.array([end_id], "<u4").tobytes())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, table = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        order = np.insert(words.indices.to_numpy(), ends, len(known) - 1)
        ids, before = [table[:0]], [np.zeros(1, np.int64)]
        for at in range(0, len(order), GATHERED_WORDS):
            some = order[at : at + GATHERED_WORDS]
            each = sizes[some]
            stops = np.cumsum(each)
            ids.append(table[np.arange(stops[-1]) + np.repeat(starts[some] - stops + each, each)])
            before.append(before[-1][-1] + stops)
        stops = np.concatenate(before)[ends + np.arange(1, len(ends) + 1)]
        return np.concatenate(ids), np.diff(stops, prepend=0)


class WordMemory(Memory):
    """A Memory asked for many words at once; long ones pass through."""

    def of(self, words: list[str], learned: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Results of distinct words, by ``learned`` of those not known."""
        found = list(map(self.get, words))
        lacking = [at for at, data in enumerate(found) if data is None]
        if self.older:
            for at in lacking:
                found[at] = self.older.get(words[at])
        fresh = [at for at in lacking if found[at] is None]
        if fresh:
            for at, data in zip(fresh, learned([words[at] for at in fresh])):
                found[at] = data
        if len(self) + len(lacking) > self.most:
            self.older = dict(self)
            self.clear()
        self.update((words[at], found[at]) for at in lacking if len(words[at]) <= WORD_CHARS)
        return found


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def words_of(text: str | None) -> list[str]:
    return (text or "").replace("\n", " ").split(" ")


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Writes ``doc_id`` and ``text`` as blocks in ascending order of doc_id below ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(tokenizer_path)
        state = {"block": 0, "start": 0}
        ids, held, doc_ids, lengths, part = [], 0, [], [], 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            grammar = compress(flat, own.size)
            row = {
                "part": part, "block": state["block"], "start": state["start"], "n_tokens": len(flat),
                "base": own.size, "doc_ids": doc_ids, "lengths": lengths,
                "symbols": grammar.symbols.astype("<u2" if own.size + len(grammar.rules) <= 1 << 16 else "<u4").tobytes(),
                "rules": grammar.rules.astype("<u4").tobytes(),
                "rule_lengths": grammar.lengths.astype("<u8").tobytes(),
            }
            state["block"] += 1
            state["start"] += len(flat)
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for piece in slices(batch, "text"):
                found, sizes = own.encode_texts(piece.column("text"), end_id)
                part = piece.column("part")[0].as_py()
                first = done = 0
                for doc_id, size in zip(piece.column("doc_id").to_pylist(), sizes.tolist()):
                    doc_ids.append(doc_id)
                    lengths.append(size)
                    held += size
                    done += size
                    if held >= block_tokens:
                        ids.append(found[first:done])
                        yield block()
                        ids, held, doc_ids, lengths, first = [], 0, [], [], done
                ids.append(found[first:])
        if doc_ids:
            yield block()

    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(blocks, BLOCK_SCHEMA)
        .write.parquet(path)
    )


_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("base", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("symbols", pa.binary()), ("rules", pa.binary()), ("rule_lengths", pa.binary()),
    ]
)


def grammar_of(row: dict) -> Grammar:
    """The grammar in a block's row."""
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    kind = "<u2" if row["base"] + len(rules) <= 1 << 16 else "<u4"
    return Grammar(
        row["base"],
        np.frombuffer(row["symbols"], kind).astype(np.int64),
        rules.astype(np.int64),
        np.frombuffer(row["rule_lengths"], "<u8").astype(np.int64),
    )


def read_digests(blocks: DataFrame) -> DataFrame:
    """Per document of written blocks: place of its first id, count of ids and their CRC-32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                data = memoryview(grammar_of(block).decode())
                ends = np.cumsum(np.array(block["lengths"], np.int64))
                starts = ends - np.array(block["lengths"], np.int64)
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block["part"]] * len(sums), pa.int32()),
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(starts + block["start"], pa.int64()),
                        pa.array(block["lengths"], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    # One row per task that wrote: as many as the write had partitions.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    docs = blocks.mapInArrow(read, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
