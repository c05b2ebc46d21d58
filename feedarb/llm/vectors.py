"""Near duplicates among embeddings of equal label: cells of a spherical k-means, blocked cosines.

Equal vectors of a label are one class with a count.  Classes belong to the cell of the
nearest centroid and also visit each cell whose border is near: of two unit vectors at a
distance of ``d`` in different cells, at least one is within ``d / 2`` of the border, so each
linked pair meets in a cell of one of them (recall is 1 up to rounding, whatever the centroids).

A cell of a label is split into blocks of its members.  A task holds one block and lets the
members of later blocks and the visitors pass in chunks, so it never holds more, however many
vectors share a cell.  It gives sums of links per vector and edges of a spanning forest where
links are dense, not the pairs.  Components and one representative of each follow from these.

Centroids are fitted on about ``SAMPLE`` classes at most, drawn by hash; all rows are indexed.
Vectors that are null, of no length, or hold null or non-finite components link with nothing,
as do those without a label; vectors of different dimension never link.  Classes are numbered when
they are written, so ids decide nothing but the name of a component: rows may share an id or
have none.  A row without an id links like others, names no component and is never kept.
Components are read in the precision they come in, labels as 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from feedarb.llm.components import components
from feedarb.llm.shared import unit
from feedarb.plans.storage import durable

SAMPLE = 16_384
#: Classes per centroid, and centroids at most.
CELL, MOST_CELLS = 2048, 1024
BLOCK, CHUNK = 4096, 1024


def usable(vector: Column) -> Column:
    """Is it not null, without null or non-finite components, and not all zero?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares stay in range
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def centroids(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    centers = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(rounds):
        home = np.argmax(sample @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, home, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centers)
    return centers


def _assigned(classes: DataFrame, centers_by_size: dict[int, np.ndarray], reach: float) -> DataFrame:
    """Adds ``home`` and ``visits`` (cells), by the border rule."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {k: np.linalg.norm(c[:, None] - c[None], axis=2) for k, c in centers_by_size.items()}
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dims))
                centers = centers_by_size.get(dims, np.zeros((1, dims)))
                scores = units(part.column("vector")) @ centers.T
                home = np.argmax(scores, axis=1)
                behind = scores[np.arange(len(home)), home][:, None] - scores
                near = behind <= reach * gaps.get(dims, np.zeros((1, 1)))[home] + 1e-9
                near[np.arange(len(home)), home] = False
                visits = [np.flatnonzero(row).tolist() for row in near]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(home.astype(np.int32)), pa.array(visits, pa.list_(pa.int32()))],
                    [*part.schema.names, "home", "visits"],
                )

    vector = classes.schema["vector"].dataType.simpleString()
    schema = f"label long, vector {vector}, dims int, cls long, copies long, home int, visits array<int>"
    return classes.select("label", "vector", "dims", "cls", "copies").mapInArrow(assign, schema)


def _spread(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges with the components of the bipartite links ``hits`` between two lists of ids."""
    rows, columns = np.nonzero(hits)
    if len(rows) <= 4 * (len(left) + len(right)):
        return list(zip(left[rows].tolist(), right[columns].tolist()))
    mark = np.arange(len(right))
    while True:  # smallest column reachable
        own = np.where(hits, mark[None], len(right)).min(axis=1)
        back = np.minimum(mark, np.where(hits, own[:, None], len(right)).min(axis=0))
        if (back == mark).all():
            break
        mark = back
    some = own < len(right)
    edges = list(zip(left[some].tolist(), right[own[some]].tolist()))
    return edges + [(a, b) for a, b in zip(right.tolist(), right[mark].tolist()) if a != b]


LINKS = "cls long, found long, a long, b long"


def _unit_links(placed: DataFrame, least: float) -> DataFrame:
    """Per block: rows (cls, found) of links counted and rows (a, b) of edges."""

    def output(counts: dict[int, int], edges: list[tuple[int, int]]) -> pa.RecordBatch:
        n, m = len(counts), len(edges)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*counts, *[None] * m], pa.int64()),
                pa.array([*counts.values(), *[None] * m], pa.int64()),
                pa.array([*[None] * n, *[a for a, _ in edges]], pa.int64()),
                pa.array([*[None] * n, *[b for _, b in edges]], pa.int64()),
            ],
            ["cls", "found", "a", "b"],
        )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple | None = None
        held: list[tuple] = []  # of the block: units, ids, copies, visits
        block: tuple | None = None
        cells = 0

        def settle() -> pa.RecordBatch | None:
            """The block is complete: its inner links."""
            nonlocal block
            vectors, ids, copies = (np.concatenate([h[i] for h in held]) for i in range(3))
            visits = [v for h in held for v in h[3]]
            width = 1 + max((max(v) for v in visits if v), default=0)
            there = np.zeros((len(ids), width), bool)
            for at, v in enumerate(visits):
                there[at, v] = True
            block = (vectors, ids, copies, there)
            held.clear()
            counts = np.zeros(len(ids), np.int64)
            edges: list[tuple[int, int]] = []
            for start in range(0, len(ids), CHUNK):
                hits = vectors[start : start + CHUNK] @ vectors.T >= least
                hits[np.arange(len(hits)), start + np.arange(len(hits))] = False
                counts[start : start + CHUNK] += hits @ copies
                if hits.any():
                    edges += _spread(hits, ids[start : start + CHUNK], ids)
            some = counts > 0
            if not some.any():
                return None
            return output(dict(zip(ids[some].tolist(), counts[some].tolist())), edges)

        def passing(part: tuple) -> pa.RecordBatch | None:
            vectors, ids, copies, _, homes = part
            mine, my_ids, my_copies, there = block
            hits = vectors @ mine.T >= least
            if not hits.any():
                return None
            edges = _spread(hits, ids, my_ids)
            # A pair that also meets in a cell of a lower number is counted there.
            low = homes < own[1]
            known = np.where(homes < there.shape[1], homes, 0)
            elsewhere = there[:, known].T & (low & (homes < there.shape[1]))[:, None]
            hits &= ~elsewhere
            counts: dict[int, int] = {}
            for keys, found in ((ids, hits @ my_copies), (my_ids, copies @ hits)):
                for key, n in zip(keys[found > 0].tolist(), found[found > 0].tolist()):
                    counts[key] = counts.get(key, 0) + n
            return output(counts, edges)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("label", "cell", "dims", "unit", "passes")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                key, passes = tuple(keys[first][:4].tolist()), keys[first][4]
                if key != own:
                    if held and (out := settle()) is not None:
                        yield out
                    own, block = key, None
                    held.clear()
                for start in range(first, end, CHUNK):
                    part = batch.slice(start, min(CHUNK, end - start))
                    rows = (
                        units(part.column("vector")), part.column("cls").to_numpy(), part.column("copies").to_numpy(),
                        part.column("visits").to_pylist(), part.column("home").to_numpy(),
                    )
                    if not passes:
                        held.append(rows)
                        continue
                    if held and (out := settle()) is not None:
                        yield out
                    if block is not None and (out := passing(rows)) is not None:
                        yield out
        if held and (out := settle()) is not None:
            yield out

    order = ["label", "cell", "dims", "unit", "passes"]
    return placed.repartition(*order[:4]).sortWithinPartitions(*order).mapInArrow(compared, LINKS)


def near_duplicates(rows: DataFrame, least: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row (vec_id, embedding, label)."""
    single = rows.schema["embedding"].dataType == ArrayType(FloatType(), rows.schema["embedding"].dataType.containsNull)
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"),
    )
    can_link = F.col("label").isNotNull() & usable(F.col("vector"))
    classes = durable(
        rows.where(can_link)
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .select(
            "label", "vector", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("cls"), "copies", "first"
        ),
        "classes",
    )
    reach = float(np.sqrt(2 - 2 * least)) / 2
    total = classes.count()
    drawn = classes.where(unit(F.col("vector"), F.col("label"), seed=3) < SAMPLE / max(1, total))
    sample = drawn.orderBy("label", "vector").select("dims", "vector").toArrow().combine_chunks()
    by_size: dict[int, np.ndarray] = {}
    sizes = sample.column("dims").to_numpy()
    for dims in np.unique(sizes).tolist():
        part = units(sample.filter(pa.array(sizes == dims)).column("vector").combine_chunks())
        cells = int(np.clip(total * len(part) / len(sizes) / CELL, 1, MOST_CELLS))
        by_size[dims] = centroids(part, cells)
    assigned = durable(_assigned(classes, by_size, reach), "assigned")

    # Blocks of each cell's members; the sizes are one row per cell that has too many.
    members = assigned.groupBy("label", F.col("home").alias("cell"), "dims").agg(F.count("*").alias("members"))
    blocks = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).drop("members")
    cells = assigned.withColumn(
        "at", F.explode(F.concat(F.array(F.struct(F.col("home").alias("cell"), F.lit(False).alias("visitor"))),
                                 F.transform("visits", lambda c: F.struct(c.alias("cell"), F.lit(True).alias("visitor")))))
    )
    cells = cells.select("*", "at.cell", "at.visitor").drop("at").join(blocks, ["label", "cell", "dims"])
    own_block = F.pmod(F.xxhash64("cls"), F.col("blocks").cast("long")).cast("int")
    last = F.when(F.col("visitor"), F.col("blocks") - 1).otherwise(own_block)
    placed = cells.withColumn("own", own_block).withColumn("unit", F.explode(F.sequence(F.lit(0), last)))
    placed = placed.select(
        "label", "cell", "dims", "unit", (F.col("visitor") | (F.col("unit") < F.col("own"))).cast("int").alias("passes"),
        "vector", "cls", "copies", "visits", "home",
    )
    found = durable(_unit_links(placed, least), "links")

    counts = found.where("cls is not null").groupBy("cls").agg(F.sum("found").alias("found"))
    joined = durable(components(found.where("a is not null")).withColumnRenamed("node", "cls"), "joined")
    names = joined.join(classes.select("cls", "first"), "cls").groupBy("component").agg(F.min("first").alias("name"))
    # Each class of a component of several; one name a component, written so that its size is known.
    named = joined.join(durable(names, "names"), "component").select("cls", "name", F.lit(True).alias("linked"))
    named = (
        classes.join(counts, "cls", "left")
        .join(named, "cls", "left")
        .select(
            F.col("label").alias("own_label"), F.col("vector").alias("own_vector"),
            (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("links"),
            F.when(F.col("linked"), F.col("name")).otherwise(F.col("first")).alias("component"),
        )
    )
    same = (F.col("label") == F.col("own_label")) & (F.col("vector") == F.col("own_vector")) & usable(F.col("vector"))
    return rows.join(named, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )
