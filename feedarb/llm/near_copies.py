"""Groups of texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

Texts with equal sets of shingles are one node.  A node has ``BANDS`` keys of ``ROWS`` MinHash
values each: of two nodes with similarity 0.8, three pairs in a million agree in no key, and
fewer above.  Pairs that agree in one are compared exactly, shingle by shingle, in two passes:
first each node with the next of its key in an order of the key's own, which ties a large group
of copies together without all its pairs; then across the components that still share a key.
There a key with few nodes outside its largest component gives all pairs.  Keys with more, such
as those of a template, give none: their nodes are compared where they share rare shingles and
have enough left to be similar, which loses no similar pair and does not meet texts that have
only the template in common.

Words are those of SimHash: lower-cased in ASCII, parted by white space.  Texts of fewer words
than a shingle are one shingle; texts without words are copies of each other.

With a ``distance`` texts are first grouped by SimHash (``simhash.py``): those whose fingerprints
differ in so many bits at most are one component whatever their shingles, and the passes above
look for what fingerprints leave apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedarb.llm import simhash
from feedarb.llm.components import components
from feedarb.llm.shared import only, slices, word_blocks
from feedarb.plans.storage import durable

SEED = 42
WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
#: Nodes outside a key's largest component up to which all pairs across are made.
FEW = 4
#: Nodes of a key that are ordered at a time.
MOST = 100_000
#: Room for rounding in bounds; exact counts are compared afterwards.
_SLACK = 1e-6
_FLIPS, _FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64, endpoint=False) | np.array([[0], [1]], np.uint64)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The distinct XXH64 hashes of all word shingles, in order; none without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found: set[int] = set()
    carried: list[bytes] = []
    for words in word_blocks((text or "").encode().lower()):
        words = carried + words
        found.update(digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size))))
        carried = words[-(size - 1) :] if size > 1 else []
    if not found and carried:
        found.add(digest(b" ".join(carried), SEED))
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def keys(hashes: np.ndarray) -> list[int]:
    """A signed long for each band; none without shingles."""
    import xxhash

    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at : at + 1024, None] ^ _FLIPS) * _FACTORS).min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    return [int(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), i)).view(np.int64)) for i, row in enumerate(rows)]


def _marked(docs: DataFrame, prints: bool) -> DataFrame:
    """``doc_id``, ``text_hash``, ``node``, ``keys`` and ``fp`` of each row; ``fp`` null unless asked for."""
    import xxhash

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        for batch in batches:
            nodes, of_band, fps = [], [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py())
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                of_band.append(keys(hashes))
                fps.append(np.uint64(simhash.fingerprint(text.as_py())).view(np.int64) if prints else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(of_band, pa.list_(pa.int64())),
                    pa.array(fps, pa.int64()),
                ],
                ["doc_id", "text_hash", "node", "keys", "fp"],
            )

    return docs.mapInArrow(taken, "doc_id long, text_hash long, node long, keys array<long>, fp long")


def by_fingerprint(marked: DataFrame, distance: int) -> DataFrame:
    """Pairs ``a``, ``b`` that join all nodes whose texts' fingerprints reach each other.

    A node has the fingerprint of each of its texts, which may differ in order and repeats.
    """
    prints = durable(marked.select("node", "fp").distinct(), "prints")
    joined = components(simhash.links(prints.select("fp").distinct(), distance)).withColumnRenamed("node", "fp")
    named = prints.join(joined, "fp", "left").select("node", F.coalesce("component", "fp").alias("component"))
    named = durable(named.distinct(), "by-print")
    least = named.groupBy("component").agg(F.min("node").alias("a"), F.count("*").alias("nodes")).where("nodes > 1")
    return named.join(least, "component").where("a < node").select("a", F.col("node").alias("b")).distinct()


def _hashed(docs: DataFrame) -> DataFrame:
    """``node`` and ``hashes``, the sorted distinct shingle hashes of its text as signed longs."""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(t.as_py()) for t in part.column("text")]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int64)
                if ends[-1] >> 31:
                    raise ValueError("a text has over two billion different shingles")
                held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("node"), held], ["node", "hashes"])

    return docs.select("node", "text").mapInArrow(taken, "node long, hashes array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar, counted hash by hash."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b")), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(common >= least * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def by_rare_shingles(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` of different components that may be similar: all that are, few others.

    ``members`` are ``node`` and ``component``.  Shingles are taken in one order for all, the
    rarest among the members first.  Similar sets share one of the first shingles of each, those
    up to the last place that leaves enough; and from the first shared place on, both must have
    as many left as they need in common.
    """
    own = members.join(sets, "node").select("node", "component", F.size("hashes").alias("n"), "hashes")
    found = own.select("node", "component", "n", F.explode("hashes").alias("shingle"))
    counts = found.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    of_node = Window.partitionBy("node")
    # Shingles of one member alone come first and are only counted.
    placed = found.join(counts, "shingle").select(
        "node",
        "component",
        "n",
        "shingle",
        (F.col("n") - F.count("*").over(of_node) + F.row_number().over(of_node.orderBy("held", "shingle"))).alias("place"),
    )
    early = durable(
        placed.where(F.col("n") - F.col("place") + 1 >= least * F.col("n") - _SLACK)
        .select("shingle", "node", "component", "n", (F.col("n") - F.col("place") + 1).alias("left")),
        "early",
    )
    x, y = early.alias("x"), early.alias("y")
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.least("x.left", "y.left") >= least / (1 + least) * (F.col("x.n") + F.col("y.n")) - _SLACK),
    )
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _chains(rows: DataFrame, most: int) -> DataFrame:
    """``node``, ``key`` and ``before``, the node before it in its key; for keys of several nodes.

    A key of more than ``most`` nodes is ordered in blocks, whose first nodes are then ordered.
    """
    turn = F.xxhash64("node", "key")
    counts = durable(rows.groupBy("key").count().where("count > 1"), "counts")
    blocks = F.when(F.col("count") > most, F.pmod(turn, F.ceil(F.col("count") / most))).otherwise(0)
    rows = rows.join(counts, "key").select("node", "key", blocks.alias("block"), turn.alias("turn"))
    own = Window.partitionBy("key", "block").orderBy("turn", "node")
    found = rows.select("node", "key", "block", "turn", F.lag("node").over(own).alias("before"))
    if counts.where(F.col("count") > most).isEmpty():
        return found.select("node", "key", "before")
    found = durable(found, "blocks")
    across = Window.partitionBy("key").orderBy("block")
    firsts = found.where("before is null").select("node", "key", "block", F.lag("node").over(across).alias("before"))
    return found.where("before is not null").select("node", "key", "before").unionByName(firsts.drop("block"))


def candidates(known: DataFrame, first: DataFrame, sets: DataFrame, least: float, few: int = FEW) -> DataFrame:
    """Pairs that share a key and no component, after the first pass.

    ``known`` are ``node``, ``key`` and ``component``.  Where all but ``few`` nodes of a key are in
    one component its pairs are made; members of other keys are looked through for rare shingles.
    """
    sizes = known.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("count", "component"))["component"].alias("largest"),
        F.count("*").alias("several"),
        (F.sum("count") - F.max("count")).alias("others"),
    )
    split = durable(largest.where("several > 1").select("key", "largest", "others"), "split")
    small = known.join(split.where(F.col("others") <= few), "key")
    rest = small.where("component != largest").select("key", F.col("node").alias("x"), F.col("component").alias("of_x"))
    made = (
        small.join(rest, "key")
        .where("component != of_x and (component = largest or node > x)")
        .select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b"))
        .distinct()
    )
    large = split.where(F.col("others") > few).select("key")
    members = durable(known.join(large, "key", "left_semi").select("node", "component").distinct(), "members")
    made = made.union(by_rare_shingles(members, sets, least)).distinct()
    return made.join(first, ["a", "b"], "left_anti")


def near_copies(
    docs: DataFrame, least: float = SIMILARITY, few: int = FEW, most: int = MOST, distance: int | None = None
) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest doc_id reachable from copy to copy.

    One row per row of ``docs``; ids must not be null.  ``few`` and ``most`` decide how pairs are
    found (see ``candidates`` and ``_chains``), not which.  Texts within ``distance`` bits by
    SimHash are copies as well.
    """
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    marked = durable(_marked(hashed, distance is not None), "marked")
    nodes = durable(
        marked.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.any_value("keys").alias("keys")),
        "nodes",
    )
    shared = durable(_chains(nodes.select("node", F.explode("keys").alias("key")), most), "shared")
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "first.*")
    texts = hashed.join(wanted, ["doc_id", "text_hash"]).select("node", "text")
    sets = durable(_hashed(texts.dropDuplicates(["node"])), "sets")

    ends = (F.least("node", "before").alias("a"), F.greatest("node", "before").alias("b"))
    first = shared.where("before is not null").select(*ends).distinct()
    if distance is None:
        first = durable(first, "pairs")
        links = durable(_similar(first, sets, least), "links")
    else:
        same = durable(by_fingerprint(marked, distance), "same")
        print_of = components(same)
        # Pairs that fingerprints have joined already need no exact comparison.
        known = [
            print_of.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab"
        ]
        apart = first.join(known[0], "a", "left").join(known[1], "b", "left").where("of_a is null or of_b is null or of_a != of_b")
        first = durable(apart.select("a", "b"), "pairs")
        links = durable(_similar(first, sets, least).union(same), "links")
    joined = durable(components(links), "joined")

    known = shared.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    further = durable(_similar(durable(candidates(durable(known, "known"), first, sets, least, few), "across"), sets, least), "further")
    groups = components(links.union(further)).withColumnRenamed("component", "group")

    named = nodes.select("node", F.col("first.doc_id").alias("first")).join(groups, "node", "left")
    named = durable(named.select("node", "first", F.coalesce("group", "node").alias("group")), "named")
    smallest = named.groupBy("group").agg(F.min("first").alias("component_id"))
    labels = named.join(smallest, "group").select("node", "component_id")
    return marked.join(labels, "node").select("doc_id", "component_id")
