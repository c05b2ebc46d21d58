from __future__ import annotations

import math
import random

from feedarb.llm import vectors
from tests.llm.test_simhash import plain_components

SCHEMA = "vec_id long, embedding array<float>, label int, cls int, copies string, component_id int"


def plain(rows, least=0.98):
    ok = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            norm = math.sqrt(sum(x * x for x in v))
            ok[i] = (label, [x / norm for x in v])
    pairs = [
        (a, b) for a in ok for b in ok
        if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1])
        and sum(x * y for x, y in zip(ok[a][1], ok[b][1])) >= least
    ]
    links = {i: 0 for i, _, _ in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    least_id = plain_components(list(links), pairs)
    return {(i, links[i], least_id[i], least_id[i] == i) for i in links}


def run_rows(spark, rows):
    data = spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA)
    found = vectors.near_duplicates(data).collect()
    assert len(found) == len(rows)
    return [tuple(r) for r in found]


def run(spark, rows):
    return set(run_rows(spark, rows))


def some_rows(count, dims=6, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        if rows and draw.random() < 0.6:
            base = draw.choice(rows[-20:])[1]
            v = [x + draw.gauss(0, 0.05) for x in base] if draw.random() < 0.8 else list(base)
        else:
            v = [draw.gauss(0, 1) for _ in range(dims)]
        rows.append((i, [round(x, 3) for x in v], draw.randrange(3)))
    return rows


def test_equals_all_pairs(spark):
    rows = some_rows(400)
    assert run(spark, rows) == plain(rows)


def test_many_cells_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 20)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "CHUNK", 5)
    rows = some_rows(500, seed=2)
    assert run(spark, rows) == plain(rows)


def test_awkward_vectors(spark):
    rows = [
        (1, None, 0), (2, [0.0, 0.0], 0), (3, [None, 1.0], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [], 0),
        (7, [1.0, 1.0], None), (8, [1.0, 1.0], 0), (9, [2.0, 2.0], 0), (10, [1.0, 1.0], 0), (11, [1.0, 1.0], 1), (12, [1.0, 1.0, 0.0], 0),
        (13, [1e-30, 1e-30], 0), (14, [-1.0, -1.0], 0),
    ]
    found = {r[0]: r for r in run(spark, rows)}
    assert found == {r[0]: r for r in plain(rows)}
    assert run(spark, []) == set()


def test_repeated_ids_are_vectors_of_their_own(spark):
    assert sorted(run_rows(spark, [(5, [1.0, 0.0], 0), (5, [0.0, 1.0], 0), (6, [1.0, 0.01], 0)])) == [
        (5, 0, 5, True), (5, 1, 5, True), (6, 1, 5, False),
    ]


def test_rows_without_an_id_link_like_others(spark):
    rows = [(None, [1.0, 0.0], 0), (8, [1.0, 0.01], 0), (7, [1.0, 0.02], 0), (None, [0.0, 1.0], 0), (None, [0.0, 1.0], 0), (None, None, 0)]
    found = run_rows(spark, rows)
    assert sorted(found, key=str) == sorted(
        [(None, 2, 7, False), (8, 2, 7, False), (7, 2, 7, True), (None, 1, None, False), (None, 1, None, False), (None, 0, None, False)],
        key=str,
    )


def test_long_labels_and_double_precision(spark):
    big = 2**32
    rows = [(1, [1.0, 0.0], big), (2, [1.0, 0.0], 0), (3, [1.0, 1e-3], big), (4, [1.0, 1e-12], big)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert {tuple(r) for r in vectors.near_duplicates(data).collect()} == plain(rows)
    # cos = 0.98 lies between these two, which single precision makes one vector.
    edge = math.sqrt(1 / 0.98**2 - 1)
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, edge - 1e-12], 0), (3, [1.0, edge + 1e-12], 0)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert sorted(tuple(r) for r in vectors.near_duplicates(data).collect()) == [(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)]


def test_recall_of_the_registered_query(spark):
    from feedarb.llm import queries

    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    draw = random.Random(3)
    copies = [(10_000 + i, [x + draw.gauss(0, 0.004) for x in v], label) for i, v, label in rows[:150]]
    want = plain(rows + copies)
    got = run(spark, rows + copies)
    links = sum(r[1] for r in want)
    assert links >= 100 and sum(r[1] for r in got) >= 0.9 * links
    assert {tuple(r) for r in queries.op9_embeddings(spark, "/root/testdata/sf0.001").collect()} == plain(rows)
