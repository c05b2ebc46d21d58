from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from feedarb.llm import lexical
from tests.llm.rows import AWKWARD, documents

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ONE_CASE = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return PATTERN.findall((text or "").translate(ONE_CASE))


def plain(items, docs, best=10):
    """By the formula, for rows (item_id, text) and (doc_id, text)."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    documents, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 25 + 75 * c.total() * documents // words
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:best], 1):
            rows.append((item, rank, None if null else doc, -score))
    return sorted(rows, key=repr)


def make(spark, items):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, n long, terms string, block int")


def some(seed, docs=60, items=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "éTÉ", "naïve", "漢字", "A1", "a1", "x-y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(most):
        return rng.choice([" ", ". ", "\n"]).join(rng.choices(vocabulary, weights, k=rng.randint(0, most)))

    return [(i, text(12)) for i in range(items)], [(i, text(60)) for i in range(docs)]


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_formula(spark, seed, monkeypatch):
    items, docs = some(seed)
    docs += docs[:20] + [(None, docs[3][1]), (7, None), (8, " -.- ")]
    items += [(3, items[4][1]), (None, items[5][1]), (99, None), (100, "?!"), (101, "nowhere")]
    got = lexical.ranked(make(spark, items), documents(spark, [(i, t, "a") for i, t in docs]), best=4)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(items, docs, 4)


def test_blocks_of_items_and_warm_bounds_change_nothing(spark, monkeypatch):
    items, docs = some(5, 400)
    docs = documents(spark, [(i, t, "a") for i, t in docs])
    whole = sorted(map(tuple, lexical.ranked(make(spark, items), docs).collect()))
    monkeypatch.setattr(lexical, "WARM_ROWS", 50)
    assert sorted(map(tuple, lexical.ranked(make(spark, items), docs, block_bytes=2500).collect())) == whole


def test_bounds_leave_out_much_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 16)
    monkeypatch.setattr(lexical, "FOCUS", 3)
    rng = np.random.default_rng(3)
    sizes = rng.integers(20, 90, 600).tolist()
    held = [np.sort(rng.choice(200, rng.integers(1, 12), replace=False, p=np.arange(200, 0, -1) / 20100)) for _ in sizes]
    starts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    tf = rng.integers(1, 4, starts[-1])
    entries = np.concatenate(held)
    weights = np.array([lexical.weight(600, int(n)) for n in np.bincount(entries, minlength=200)], np.int64)
    asked = [lexical.query(Counter(rng.choice(200, 10).tolist()), weights) for _ in range(20)]
    vectors = lexical.impact_vectors(sizes, starts, entries, tf, weights, 600, sum(sizes))
    own = lexical.Search(asked, [0] * 20, 5)
    own.add(list(range(600)), vectors)
    for query, found in zip(asked, own.found):
        exact = dict(zip(query.terms.tolist(), query.exact.tolist()))
        scores = []
        for doc in range(600):
            m = 25 + 75 * sizes[doc] * 600 // sum(sizes)
            rows = range(starts[doc], starts[doc + 1])
            score = sum(exact.get(int(entries[e]), 0) * (10**9 * int(tf[e]) // (1000 * int(tf[e]) + 8 * m)) for e in rows)
            scores.append((-score, False, doc))
        assert found == sorted(s for s in scores if s[0] < 0)[:5]
    pruned, filtered, scored = own.effort
    assert pruned > 0 and filtered > 0 and scored < 20 * 600 / 2


@pytest.mark.parametrize("docs", [AWKWARD, []])
def test_awkward_rows_and_empty_tables(spark, docs):
    items = [(1, "same words LONG"), (2, None), (3, "café x"), (4, "id")]
    got = lexical.ranked(make(spark, items), documents(spark, docs))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(items, [(i, t) for i, t, _ in docs])
    assert lexical.ranked(make(spark, []), documents(spark, docs)).count() == 0


def test_very_long_text_is_read_in_parts():
    data = b"Word " * 700_000 + b"End"
    found = Counter(t for words in lexical.terms(data) for t in words)
    assert found == {b"word": 700_000, b"end": 1}
