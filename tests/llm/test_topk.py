from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedarb.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank string, kind int"


def plain(rows, k):
    vectors = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in vectors:
        if q % 100:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)}
    return out


def run(spark, rows, k=10):
    data = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    data = data.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return {tuple(r) for r in topk.top_k(data.where(F.col("vec_id") % 100 == 0), data, k).collect()}


def test_random_vectors_with_ties(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice((-1.5, -0.25, 0.0, 0.1, 0.7)) for _ in range(5)]) for i in range(700)]
    assert run(spark, rows) == plain(rows, 10)


def test_many_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 3)
    monkeypatch.setattr(topk, "BLOCK", 40)
    draw = random.Random(2)
    rows = [(i * 10, [draw.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    assert run(spark, rows, 7) == plain(rows, 7)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (100, [-1.0, 0.5]), (7, [1e9, 0.0])]
    assert run(spark, rows) == plain(rows, 10)
    assert run(spark, [*rows, (None, [5.0, 5.0])]) == plain(rows, 10)
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0])]) == set()
    assert run(spark, [(0, None), (None, None)]) == set()


def test_large_components_are_exact(spark):
    rows = [(0, [0.001]), (1, [2.0**31]), (2, [2.0**32]), (3, [-(2.0**31)])]
    assert run(spark, rows) == plain(rows, 10) == {(0, 1, 2, 4398046511104), (0, 2, 1, 2199023255552), (0, 3, 3, -2199023255552)}
    # Beyond 64 bits on the way: bits of 2^80 that meet zeros only.
    rows = [(0, [0.0, 1.0]), (1, [2.0**70, 3.0]), (2, [-(2.0**70), 4.0]), (3, [2.0**52 + 1, 4.0])]
    assert run(spark, rows) == plain(rows, 10)


def test_scores_beyond_a_long_end_the_query(spark):
    with pytest.raises(Exception, match="no long holds the score of query 0 and vector 1"):
        run(spark, [(0, [2.0**40]), (1, [2.0**40])])


def test_repeated_ids(spark):
    rows = [(0, [1.0]), (0, [2.0]), (1, [3.0]), (1, [3.0])]
    data = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    data = data.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    found = [(r.query_id, r.vec_id, r.score) for r in topk.top_k(data.where("vec_id = 0"), data).collect()]
    square = 1024 * 1024
    assert sorted(found) == sorted([(0, 1, 3 * square)] * 2 + [(0, 1, 6 * square)] * 2)


def test_registered_query_equals_brute_force(spark):
    from feedarb.llm import queries

    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in queries.op6_topk(spark, "/root/testdata/sf0.001").collect()}
    assert got == plain(rows, 10)
