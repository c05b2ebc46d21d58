from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from feedarb.llm import queries, toxicity
from tests.llm.rows import AWKWARD, documents


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = queries.op5_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [p for p, y in judged if y]
    clean = [p for p, y in judged if not y]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01  # from about 3,000 labelled documents


def test_features_of_blocks_are_those_of_the_whole(monkeypatch):
    text = " ".join(f"word{i % 53}x" for i in range(500))
    whole = set(np.concatenate([*toxicity.features(text)]).tolist())
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert set(np.concatenate([*toxicity.features(text)]).tolist()) == whole


def test_learner_is_the_textbook_update():
    model = toxicity.Ftrl(3)
    z, n = np.zeros(4), np.zeros(4)
    for at, label in (([0, 1, 3], 1), ([1, 2, 3], 0), ([0, 3], 1), ([2, 3], 0)) * 20:
        w = [
            0 if abs(z[i]) <= toxicity.L1
            else -(z[i] - np.sign(z[i]) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)
            for i in at
        ]
        g = 1 / (1 + np.exp(-sum(w))) - label
        for i, own in zip(at, w):
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA * own
            n[i] += g * g
        model.learn(np.array(at), label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_awkward_rows_and_labels(spark):
    docs = documents(spark, AWKWARD)
    labels = spark.createDataFrame([(3, 1, 1), (6, 1, 0), (6, 1, None), (None, 1, 1), (99, 1, 1), (7, 1, 5)], "doc_id long, text int, toxic int")
    weights = toxicity.fit(docs, labels)
    scores = docs.select("doc_id", toxicity.scored(docs, weights).alias("score")).collect()
    assert len(scores) == len(AWKWARD) and all(0 <= r.score <= 1 for r in scores)
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r[0] < 0.5 for r in docs.select(toxicity.scored(docs, none)).collect())
    assert not spark.range(1).select(toxicity.held_out(F.lit(None).cast("long"))).first()[0]
