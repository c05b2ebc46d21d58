"""Ranked lexical search: the k best documents of each item, exact in integers.

A document is an impact vector over the terms that items use: per term
``(10**9 * tf) div (1000 * tf + 8 * m)`` with ``m = 25 + (75 * n * N) div L``, times the term's
weight ``floor(1000 * ln((2N + 2) / (2df + 1)))`` that items and documents share by its square
root.  The score is then an inner product, and so:

* every batch of vectors is ordered by length and cut into buckets; a bucket, and all after
  it, is left out for an item once its longest vector times the item's length is below the
  item's k-th best score (Cauchy-Schwarz);
* inside a bucket the item's largest coordinates are added up, and a document survives if
  this sum and the product of what remains of both lengths reach the k-th best score;
* survivors are scored again from the integers.

Bounds are widened by a little more than rounding can take away, and only documents strictly
below are left out, so results are exact, ties included.  A bounded sample of vectors, scored
first, gives every task lower bounds of the k-th best scores to begin with; they never
exclude a document that belongs to the result.

Items are taken in blocks of bounded size, each block against all documents; what is broadcast
is one block's items and terms.  A task keeps k documents an item and sends those.

Null and empty texts have no terms: such items get no rows, such documents are not counted.
Repeated rows are documents, or items, of their own; equal scores are ordered by ``doc_id``,
null ids last.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedarb.llm.shared import slices, word_blocks
from feedarb.plans.ordered import running_sum
from feedarb.plans.storage import durable

BEST = 10
#: Bytes of the items that are searched for at a time, with what each item takes besides its text.
BLOCK_BYTES = 8 << 20
ITEM_BYTES = 1024
#: Vectors that give first lower bounds, about.
WARM_ROWS = 4096
BUCKET_ROWS = 2048
#: Coordinates of an item that are added up before documents are left out.
FOCUS = 12
#: More than the relative error of a bound.
SLACK = 1e-9

_ONE_CASE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(data: bytes) -> Iterator[list[bytes]]:
    """Runs of ASCII letters, digits and all that is not ASCII, only A-Z in lower case; in lists of bounded size."""
    return word_blocks(data.translate(_ONE_CASE))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Query(NamedTuple):
    """An item: its terms (ascending), their integer and square-root weights, times occurrences."""

    terms: np.ndarray
    exact: np.ndarray
    coordinates: np.ndarray
    length: float


class Vectors(NamedTuple):
    """Documents of a batch by descending length; row i has the entries from ``starts[i]``."""

    rows: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    values: np.ndarray


def query(counted: Counter[int], weights: np.ndarray) -> Query:
    at = np.array(sorted(counted), np.int64)
    often = np.array([counted[t] for t in at.tolist()], np.int64)
    coordinates = often * np.sqrt(weights[at])
    return Query(at, often * weights[at], coordinates, float(np.sqrt((coordinates**2).sum())))


def impact_vectors(sizes: list[int], starts: np.ndarray, held: np.ndarray, tf: np.ndarray, weights: np.ndarray, documents: int, words: int) -> Vectors:
    """From documents' term counts, the places of their entries, and terms and frequencies there."""
    m = np.array([25 + 75 * n * documents // words for n in sizes], np.int64)
    counts = np.diff(starts)
    impacts = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, counts))
    values = impacts * np.sqrt(weights[held])
    owner = np.repeat(np.arange(len(sizes)), counts)
    lengths = np.sqrt(np.bincount(owner, values**2, len(sizes)))
    rows = np.argsort(-lengths, kind="stable")
    taken = _entries(starts[rows], counts[rows])
    new = np.concatenate([[0], np.cumsum(counts[rows])])
    return Vectors(rows, lengths[rows], new, held[taken], impacts[taken], values[taken])


def _entries(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all entries of rows, row after row."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + counts, counts)


class Bucket:
    """Neighbouring vectors and, by term, their entries."""

    def __init__(self, vectors: Vectors, first: int, end: int):
        low, high = vectors.starts[first], vectors.starts[end]
        self.vectors, self.first = vectors, first
        self.longest = float(vectors.lengths[first])
        self.lengths = vectors.lengths[first:end]
        owner = np.repeat(np.arange(end - first), np.diff(vectors.starts[first : end + 1]))
        order = np.argsort(vectors.terms[low:high], kind="stable")
        self.terms = vectors.terms[low:high][order]
        self.owner, self.values = owner[order], vectors.values[low:high][order]

    def survivors(self, asked: Query, least: int) -> np.ndarray:
        """Rows that may reach ``least``, by the largest coordinates and what is left of both lengths."""
        lows = np.searchsorted(self.terms, asked.terms)
        highs = np.searchsorted(self.terms, asked.terms, side="right")
        some = np.flatnonzero((highs > lows) & (asked.exact > 0))
        some = some[np.argsort(-asked.coordinates[some], kind="stable")]
        if not len(some):
            return some
        reached = np.zeros(len(self.lengths))
        used = np.zeros(len(self.lengths))
        for t in some[:FOCUS].tolist():
            rows, values = self.owner[lows[t] : highs[t]], self.values[lows[t] : highs[t]]
            reached[rows] += asked.coordinates[t] * values
            used[rows] += values**2
        # Terms that no document of the bucket has need no room.
        rest = math.sqrt(float((asked.coordinates[some[FOCUS:]] ** 2).sum()))
        if rest:
            squares = self.lengths**2
            reached += rest * np.sqrt(np.maximum(squares - used, 0) + SLACK * squares)
        return np.flatnonzero((reached * (1 + SLACK) + 1 >= least) & (reached > 0))

    def scores(self, asked: Query, rows: np.ndarray) -> np.ndarray:
        """Exact scores of rows."""
        vectors = self.vectors
        at = rows + self.first
        starts = vectors.starts[at]
        counts = vectors.starts[at + 1] - starts
        entries = _entries(starts, counts)
        held = vectors.terms[entries]
        places = np.minimum(np.searchsorted(asked.terms, held), len(asked.terms) - 1)
        hit = asked.terms[places] == held
        gained = np.where(hit, asked.exact[places], 0) * vectors.impacts[entries]
        sums = np.concatenate([[0], np.cumsum(gained)])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]


class Search:
    """The best documents so far of some items; ``floors`` are lower bounds of their k-th best scores."""

    def __init__(self, asked: list[Query], floors: list[int], best: int):
        self.asked, self.best = asked, best
        self.least = [max(1, f) for f in floors]
        #: Per item (-score, id is null, id), best first.
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in asked]
        #: Buckets pruned whole, documents left out inside others, documents scored.
        self.effort = [0, 0, 0]

    def add(self, doc_ids: list[int | None], vectors: Vectors) -> None:
        rows = int(np.count_nonzero(vectors.lengths))  # the others have no item's term
        open_items = list(range(len(self.asked)))
        for first in range(0, rows, BUCKET_ROWS):
            if not open_items:
                break
            bucket = Bucket(vectors, first, min(first + BUCKET_ROWS, rows))
            reach = bucket.longest * (1 + SLACK)
            left = [i for i in open_items if self.asked[i].length * reach + 1 >= self.least[i]]
            self.effort[0] += len(open_items) - len(left)
            open_items = left
            for item in open_items:
                self._look(item, bucket, doc_ids)

    def _look(self, item: int, bucket: Bucket, doc_ids: list[int | None]) -> None:
        rows = bucket.survivors(self.asked[item], self.least[item])
        self.effort[1] += len(bucket.lengths) - len(rows)
        if not len(rows):
            return
        scores = bucket.scores(self.asked[item], rows)
        self.effort[2] += len(rows)
        if len(rows) > self.best:
            kth = int(np.partition(scores, -self.best)[-self.best])
            self.least[item] = max(self.least[item], kth)
        enough = scores >= self.least[item]
        if not enough.any():
            return
        for row, score in zip(bucket.vectors.rows[rows[enough] + bucket.first].tolist(), scores[enough].tolist()):
            doc = doc_ids[row]
            self.found[item].append((-score, doc is None, 0 if doc is None else doc))
        self.found[item] = sorted(self.found[item])[: self.best]
        if len(self.found[item]) == self.best:
            self.least[item] = max(self.least[item], -self.found[item][-1][0])


def _vectors_of(docs: DataFrame, sent) -> DataFrame:
    """(doc_id, n, terms, tf) of documents with terms; only terms that the broadcast table has."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                ids, sizes, held, often, ends = [], [], [], [], [0]
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary())):
                    counts: Counter[int | None] = Counter()
                    for words in terms(text.as_py() or b""):
                        counts.update(map(known.get, words))
                    if not counts:
                        continue
                    ids.append(doc_id)
                    sizes.append(counts.total())
                    counts.pop(None, None)
                    held += counts.keys()
                    often += counts.values()
                    ends.append(len(held))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "tf"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(counted, "doc_id long, n long, terms array<int>, tf array<long>")


def _searched(vectors: DataFrame, sent, best: int) -> DataFrame:
    """(_n, doc_id, score): the best documents that a task has for each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, asked, floors, weights, documents, words = sent.value
        own = Search([query(a, weights) for a in asked], floors, best)
        for batch in batches:
            if not batch.num_rows:
                continue
            held, tf = batch.column("terms"), batch.column("tf")
            starts = held.offsets.to_numpy().astype(np.int64)
            low, high = starts[0], starts[-1]
            entries = held.values.to_numpy()[low:high].astype(np.int64)
            often = tf.values.to_numpy()[tf.offsets[0].as_py() : tf.offsets[-1].as_py()]
            own.add(
                batch.column("doc_id").to_pylist(),
                impact_vectors(batch.column("n").to_pylist(), starts - low, entries, often, weights, documents, words),
            )
        for number, found in zip(numbers, own.found):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(found), pa.int64()),
                        pa.array([None if null else doc for _, null, doc in found], pa.int64()),
                        pa.array([-score for score, _, _ in found], pa.int64()),
                    ],
                    ["_n", "doc_id", "score"],
                )

    return vectors.mapInArrow(search, "_n long, doc_id long, score long")


def _kth_scores(found: DataFrame, best: int) -> dict[int, int]:
    """By item the k-th best score in ``found``, where there are as many."""
    last = _ranked(found, best).where(F.col("rank") == best)
    return {row["_n"]: row["score"] for row in last.select("_n", "score").collect()}


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = W.partitionBy("_n").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _blocks(items: DataFrame, block_bytes: int) -> DataFrame:
    """Items with terms to look for, numbered, and dealt to blocks of ``block_bytes`` and one item at most."""
    cost = F.octet_length("text") + ITEM_BYTES
    written = durable(
        items.where("text is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), "text")
        .withColumn("_n", F.monotonically_increasing_id()),
        "items",
    )
    return durable(
        running_sum(written, [], "_n", cost, "_upto").withColumn("block", F.floor((F.col("_upto") - 1) / block_bytes).cast("long")),
        "item-blocks",
    )


def ranked(items: DataFrame, docs: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's best documents with a score above 0.

    ``items`` has item_id and text, ``docs`` doc_id and text.
    """
    spark = docs.sparkSession
    numbered = _blocks(items, block_bytes)
    last = numbered.agg(F.max("block")).first()[0]
    parts = []
    for block in range(0 if last is None else last + 1):
        rows = numbered.where(F.col("block") == block).select("_n", "text").toArrow()
        if rows.num_rows:
            parts.append(_block_best(docs, rows, best))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return _ranked(found, best).join(numbered.select("_n", "item_id"), "_n").select("item_id", "rank", "doc_id", "score")


def _block_best(docs: DataFrame, rows: pa.Table, best: int) -> DataFrame:
    """The best documents of each task for one block of items, with the items' numbers ``_n``."""
    context = docs.sparkSession.sparkContext
    known: dict[bytes, int] = {}
    asked: list[Counter[int]] = []
    numbers: list[int] = []
    for number, text in zip(rows.column("_n").to_pylist(), rows.column("text").to_pylist()):
        counted = Counter(known.setdefault(t, len(known)) for words in terms(text.encode()) for t in words)
        if counted:
            asked.append(counted)
            numbers.append(number)
    vectors = durable(_vectors_of(docs, context.broadcast(known)), "impacts")
    documents, words = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.full(len(known), weight(documents, 0), np.int64)
    # One count a term of the block.
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_batches():
        weights[row.column("term").to_numpy()] = [weight(documents, df) for df in row.column("count").to_pylist()]


    def search(among: DataFrame, floors: dict[int, int]) -> DataFrame:
        known_least = [floors.get(n, 0) for n in numbers]
        return _searched(among, context.broadcast((numbers, asked, known_least, weights, documents, words)), best)

    if documents <= WARM_ROWS:
        return search(vectors, {})
    sample = vectors.sample(WARM_ROWS / documents, seed=11)
    return search(vectors, _kth_scores(search(sample, {}), best))
