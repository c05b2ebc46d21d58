from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from feedarb.llm import near_copies, simhash
from tests.llm.rows import documents
from tests.llm.test_simhash import plain_components

SF = "/root/testdata/sf0.001"


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({b" ".join(words)} if words else set())


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def changed(draw, words, count):
    """The words with so many of them replaced, far from each other."""
    words = list(words)
    for at in draw.sample(range(0, len(words), 6), count):
        words[at] = f"x{draw.randrange(10**9)}"
    return words


def some_texts(draw):
    texts = ["", " \n", "one two", "One  Two", "one two three", "a b c d e f g"]
    for _ in range(20):
        words = [f"w{draw.randrange(5_000)}" for _ in range(draw.choice([60, 200, 400]))]
        texts += [" ".join(words), " ".join(words + ["end"])]
        texts += [" ".join(changed(draw, words, len(words) // 60 * n)) for n in (1, 1, 2, 3)]
    return texts


def test_shingles_and_similarity(spark):
    for text in (None, "", "One", "a b c d", "a b c d e", "A b c d e f a b c d e"):
        assert len(near_copies.shingles(text)) == len(plain_shingles(text))
    texts = [(1, "a b c d e f"), (2, "a b c d e f g"), (3, "x"), (4, "")]
    sets = near_copies._hashed(spark.createDataFrame(texts, "node long, text string"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "a long, b long")
    for least, want in ((2 / 3, [(1, 2)]), (0.67, [])):
        assert [tuple(r) for r in near_copies._similar(pairs, sets, least).collect()] == want


def test_groups_against_all_pairs(spark):
    texts = some_texts(random.Random(8))
    sets = [plain_shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])]
    want = plain_components(range(len(texts)), pairs)
    found = near_copies.near_copies(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.component_id for r in found} == want and len(found) == len(want)
    assert len(set(want.values())) > 20


def test_stage_drops_near_copies(spark):
    draw = random.Random(9)
    words = [f"w{draw.randrange(5_000)}" for _ in range(300)]
    texts = [" ".join(words), *(" ".join(changed(draw, words, 3)) for _ in range(12))]
    prints = [simhash.fingerprint(t) for t in texts]
    assert max((p ^ prints[0]).bit_count() for p in prints) > 2  # out of reach of op3's distance
    kept = corpus_pipeline.without_near_duplicates(spark, documents(spark, [(i, t, "a") for i, t in enumerate(texts)]), SF)
    assert [r.doc_id for r in kept.collect()] == [0]


def test_second_pass_joins_what_the_first_left(spark):
    """All pairs that share a key are compared unless they are joined already."""
    draw = random.Random(10)
    words = [f"w{draw.randrange(5_000)}" for _ in range(300)]
    texts = [" ".join(changed(draw, words, 4)) for _ in range(40)]  # some pairs above 0.8, some below
    sets = [plain_shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])]
    found = near_copies.near_copies(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_components(range(len(texts)), pairs)
    assert np.array_equal(near_copies.keys(near_copies.shingles(texts[0])), near_copies.keys(near_copies.shingles(texts[0])))


def from_template(draw, count, common=200, own=70):
    """Texts that share a passage and have words of their own behind it."""
    passage = [f"w{draw.randrange(5_000)}" for _ in range(common)]
    return [" ".join(passage + [f"o{draw.randrange(10**9)}" for _ in range(own)]) for _ in range(count)]


@pytest.mark.parametrize(("few", "most"), [(0, 3), (0, 10**6), (4, 5), (10**6, 7)])
def test_all_ways_of_finding_pairs_give_the_same(spark, few, most):
    draw = random.Random(11)
    texts = some_texts(draw)[:80] + from_template(draw, 30) + from_template(draw, 30, own=30) + from_template(draw, 30, own=22)
    base = from_template(draw, 1)[0].split()
    texts += [" ".join(changed(draw, base, draw.randrange(9))) for _ in range(60)]
    sets = [plain_shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])]
    want = plain_components(range(len(texts)), pairs)
    found = near_copies.near_copies(documents(spark, [(i, t, "a") for i, t in enumerate(texts)]), few=few, most=most)
    assert {r.doc_id: r.component_id for r in found.collect()} == want


@pytest.mark.parametrize("own", [40, 70])
def test_texts_of_a_template_are_hardly_compared(spark, own):
    """Similarity 0.71 and 0.58: one key holds all of them, and no pair is left to compare."""
    texts = from_template(random.Random(12), 300, own=own)
    known = spark.createDataFrame([(i, 1, i) for i in range(300)], "node long, key long, component long")
    sets = near_copies._hashed(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    first = spark.createDataFrame([], "a long, b long")
    assert near_copies.candidates(known, first, sets, 0.8).count() == 0
    near = spark.createDataFrame([(i, texts[i] if i else texts[1] + " end") for i in range(300)], "node long, text string")
    found = near_copies.candidates(known, first, near_copies._hashed(near), 0.8)
    assert [tuple(r) for r in found.collect()] == [(0, 1)]


def repeated(draw, count):
    """Pairs of a text and the same with words behind it: nearly the same shingles by number, not as sets."""
    found = []
    for _ in range(count):
        text = " ".join(f"w{draw.randrange(5_000)}" for _ in range(11))
        found += [" ".join([text] * 60), " ".join([text] * 60 + [f"x{draw.randrange(10**9)}" for _ in range(5)])]
    return found


def test_stage_joins_by_fingerprint_and_by_similarity(spark):
    draw = random.Random(13)
    texts = [*repeated(draw, 12), *some_texts(draw)]
    texts += [f"{texts[0]} {texts[0]} end", "one two three"]
    sets, prints = [plain_shingles(t) for t in texts], [simhash.fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    similar = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])]
    assert set(near) - set(similar) and set(similar) - set(near)
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
    want = plain_components(range(len(texts)), near + similar)
    found = near_copies.near_copies(docs, distance=2).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF).collect()
    assert {r.doc_id for r in kept} == set(want.values())
