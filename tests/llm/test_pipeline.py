from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedarb.llm import byte_bpe, mixing, simhash, toxicity
from feedarb.plans.storage import durable
from tests.llm.rows import AWKWARD, documents

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "mixing", "byte_bpe"]


def test_each_stage_against_its_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic, near, mix, encode = (stage for _, stage in corpus_pipeline.STAGES)

    clean = durable(toxic(spark, docs, SF), "t")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    weights = toxicity.fit(docs, labels)
    want = {r.doc_id for r in docs.collect() if toxicity.score(r.text, weights) < 0.5}
    assert {r.doc_id for r in clean.collect()} == want and clean.columns == docs.columns

    kept = durable(near(spark, clean, SF), "n")
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in clean.collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert kept.count() == len(ids)
    for i in prints:  # who goes has a smaller one near in a chain; who stays has none
        smaller = [j for j in prints if j < i and (prints[i] ^ prints[j]).bit_count() <= 2]
        if i in ids:
            assert not smaller

    mixed = durable(mix(spark, kept, SF), "m")
    sizes = durable(mixing.sized(kept), "s")
    copies = {r.doc_id: r.copies for r in mixing.mixed(sizes, mixing.mix(sizes)).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == {i: c for i, c in copies.items() if c}
    assert mixed.columns == docs.columns

    texts = {r.doc_id: r.text for r in docs.collect()}
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    out = encode(spark, mixed, SF).collect()
    assert len(out) == mixed.count()
    for r in out:
        assert r.ids == np.frombuffer(codec.encode(texts[r.doc_id]), np.int32).tolist()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF), "stage")
        assert docs.columns == documents(spark, []).columns
    assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, documents(spark, AWKWARD), SF).collect()} == {1, 3, None, 6, 7, 8}


@pytest.mark.parametrize("place", range(4))
def test_empty_table(spark, place):
    assert corpus_pipeline.STAGES[place][1](spark, documents(spark, []), SF).count() == 0
