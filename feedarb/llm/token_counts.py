"""Token counts by a two-tier lookup in the tasks that read the texts.

Tokenizers that throw white space away never make a token across it, so a text's count is the
sum over its pre-tokens: runs of bytes between ASCII white space, special strings in them
included.  The first tier is a compact hash table of frequent pre-tokens and the lengths the
library gives them, gathered once and broadcast; the second is a cache of each worker, filled
by the library itself for what the first lacks.  Neither tier decides a result, both only save
work; no pre-token is shuffled and every text is read whole.

The table comes from a bounded sample: about ``SAMPLED_ROWS`` rows, of which each task sends
at most ``SENT_WORDS`` words, and at most ``FREQUENT_WORDS`` words of at most ``WORD_BYTES``
bytes are broadcast (1.2 MB).  Caches are bounded in bytes and start over when full; longer
words are counted where they stand.  Tokenizers that may join bytes across white space (any
``.model``, and any ``.json`` not recognised by :func:`parts_at_blanks`) count whole texts.

Null texts count as empty, with 0 bytes and tokens; repeated rows and null ids are rows like
others; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import functools
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.llm.shared import slices, word_blocks

SAMPLED_ROWS = 1_000
SENT_WORDS = 2_000
FREQUENT_WORDS = 16_384
WORD_BYTES = 72
#: Bytes of the second tier, with what Python adds to each entry.
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 160
SLICE_BYTES = 2 << 20


def parts_at_blanks(description: dict) -> bool:
    """Does this ``.json`` tokenizer drop white space, and treat what lies between runs of it alone?

    So it is if texts are only composed (NFC), set in lower case letter by letter and freed of
    runs of white space, and if pre-tokens are matches of a pattern that cannot match a blank.
    """

    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part.get(inner, [part])

    normal = steps(description.get("normalizer"), "normalizers")
    pre = steps(description.get("pre_tokenizer"), "pretokenizers")
    added = description.get("added_tokens", [])
    return (
        all(
            n["type"] in ("NFC", "Lowercase")
            or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ")
            for n in normal
        )
        and bool(pre)
        and pre[0]["type"] == "Split"
        and pre[0]["behavior"] == "Removed"
        and pre[0]["invert"]
        and _never_blank(pre[0]["pattern"].get("Regex", " "))
        and all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in pre[1:])
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        and description.get("post_processor") is None
        and not any(c.isspace() for t in added for c in t["content"])
    )


def _never_blank(pattern: str) -> bool:
    """Is every alternative a literal without blanks, or a class that leaves white space out?"""
    known = {r"[\p{L}]+", r"[\p{N}]", r"[\p{N}]+", r"[^\s\p{L}\p{N}]+", r"\p{L}+", r"\p{N}+", r"\p{N}"}
    return all(part in known or part.replace("'", "").isalnum() for part in pattern.split("|"))


class TokenCounter:
    """Counts tokens as the library of a tokenizer file does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            self.by_word = False
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: [
                len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
            with open(path, encoding="utf-8") as lines:
                self.by_word = parts_at_blanks(json.load(lines))
        self._first: dict[bytes, int] = {}
        self._known: dict[bytes, int] = {}
        self._held = 0

    def use(self, table: tuple[bytes, bytes]) -> None:
        """Take the broadcast table as first tier; the cache starts over."""
        words, lengths = table
        self._first = dict(zip(words.split(), np.frombuffer(lengths, "<u2").tolist()))
        self._known, self._held = dict(self._first), 0

    def _learn(self, words: list[bytes]) -> dict[bytes, int]:
        """Lengths of words neither tier has; those too long to be remembered."""
        passing: dict[bytes, int] = {}
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            for word, n in zip(some, self.lengths([w.decode("utf-8", "replace") for w in some])):
                if len(word) > WORD_BYTES:
                    passing[word] = n
                    continue
                if self._held > CACHE_BYTES:
                    passing |= self._known
                    self._known, self._held = dict(self._first), 0
                self._known[word] = n
                self._held += len(word) + ENTRY_BYTES
        return passing

    def count(self, data: bytes) -> int:
        """Tokens of one text given as UTF-8."""
        if not self.by_word:
            return self.lengths([data.decode("utf-8", "replace")])[0]
        total = 0
        for words in word_blocks(data):
            missing = set(words).difference(self._known)
            passing = self._learn(list(missing)) if missing else None
            if passing:
                known = self._known
                total += sum(known[w] if w in known else passing[w] for w in words)
            else:
                total += sum(map(self._known.__getitem__, words))
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter per worker process and file."""
    return TokenCounter(path)


def frequent(docs: DataFrame, path: str, rows: int = SAMPLED_ROWS, most: int = FREQUENT_WORDS) -> tuple[bytes, bytes]:
    """The first tier: words joined by blanks and their lengths, of ``most`` words of a sample."""
    if not counter(path).by_word:
        return b"", b""
    texts = docs.select("text").where("text is not null")
    share = min(1.0, rows / max(1, texts.count()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                for words in word_blocks(text.as_py()):
                    found.update(w for w in words if len(w) <= WORD_BYTES)
                    if len(found) > 32 * SENT_WORDS:
                        found = Counter(dict(found.most_common(16 * SENT_WORDS)))
        best = found.most_common(SENT_WORDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], ["word", "n"]
        )

    sent = texts.sample(share, seed=13).mapInArrow(counted, "word binary, n long").toArrow()
    totals: Counter[bytes] = Counter()
    for word, n in zip(sent.column("word").to_pylist(), sent.column("n").to_pylist()):
        totals[word] += n
    best = [w for w, _ in totals.most_common(most)]
    lengths = counter(path).lengths([w.decode("utf-8", "replace") for w in best]) if best else []
    return b" ".join(best), np.array(lengths, "<u2").tobytes()


def counted(docs: DataFrame, path: str, table: tuple[bytes, bytes] | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of each row's ``text``; ``path`` is the tokenizer's file."""
    table = frequent(docs, path) if table is None else table
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        own.use(sent.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").cast(pa.binary())
                found = [own.count(t.as_py() or b"") for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(found, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )
        own.use((b"", b""))  # a worker outlives the task

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
