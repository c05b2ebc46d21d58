from __future__ import annotations

import re
from collections import defaultdict

import pytest

from feedarb.llm import mixing, queries
from feedarb.llm.shared import unit
from feedarb.plans.storage import durable
from tests.llm.rows import AWKWARD, documents


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    left, open_sources = share * sum(sizes.values()), set(order)
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if left * weight[s] / total >= most * sizes[s]}
        if not full:
            for s in open_sources:
                target[s] = left * weight[s] / total
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_sources -= full
    return target


def check(rows, tolerance):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert r.copies in (0, 1, 2)
    target = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(target[r.source])
        assert r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance(s)


def mixed(docs):
    sizes = durable(mixing.sized(docs), "sizes")
    return mixing.mixed(sizes, mixing.mix(sizes)).collect()


def test_words_near_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixed(docs)
    assert {(r.doc_id, r.size) for r in rows} == {(d.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", d.text))) for d in docs.collect()}
    by_source = defaultdict(int)
    for r in rows:
        by_source[r.source] += r.size
    check(rows, lambda s: 0.02 * by_source[s])


def test_reruns_agree(spark):
    once, again = (queries.op7_mixing(spark, "/root/testdata/sf0.001").collect() for _ in range(2))
    assert sorted(once) == sorted(again)


def test_awkward_rows(spark):
    rows = mixed(documents(spark, AWKWARD))
    assert len(rows) == len(AWKWARD)
    longest = {"a": 0, "b": 30_000, "c": 6, None: 4}
    check(rows, lambda s: longest[s])
    assert mixed(documents(spark, [])) == []
    assert all(r.copies == 0 and r.target == 0 for r in mixed(documents(spark, [(1, "", "a"), (2, None, None)])))


def test_repeated_rows_are_taken_alike(spark):
    docs = documents(spark, [(i // 3, f"{'w ' * (1 + i // 3 % 5)}", "abc"[i // 3 % 3]) for i in range(600)])
    copies = defaultdict(set)
    rows = mixed(docs)
    for r in rows:
        copies[r.doc_id].add(r.copies)
    assert all(len(c) == 1 for c in copies.values())
    check(rows, lambda s: 15)


def plain_mix(rows, by_size):
    """Copies of each (doc_id, source, size, u) by sorting whole sources; parts by trying all limits."""
    sizes = defaultdict(int)
    for _, source, size, _ in rows:
        sizes[source] += size
    copies = {}
    for source, target in plain_targets(sizes).items():
        mine = [r for r in rows if r[1] == source]
        whole = int(target // sizes[source]) if sizes[source] else 0
        copies.update({r[0]: whole if r[2] else 0 for r in mine})
        rest = target - whole * sizes[source]
        drawn = sorted((r for r in mine if r[2]), key=lambda r: -r[2])
        while drawn and rest > 0:  # the largest size is certain as long as its part is 1 or more
            scale = rest / sum(r[2] ** (1 + by_size) for r in drawn)
            top = [r for r in drawn if r[2] == drawn[0][2]]
            if scale * top[0][2] ** by_size < 1:
                break
            for r in top:
                copies[r[0]] += 1
                rest -= r[2]
            drawn = drawn[len(top) :]
        if rest <= 0:
            continue
        ranks = []
        for doc_id, _, size, u in drawn:
            p = scale * size**by_size
            ranks.append((u / (1 - u) / (p / (1 - p)), doc_id, size))
        ranks.sort()
        while ranks and ranks[0][2] <= rest:
            _, doc_id, size = ranks.pop(0)
            copies[doc_id] += 1
            rest -= size
        closing = [(abs(rest - size), rank, doc_id) for rank, doc_id, size in ranks if size < 2 * rest]
        if closing:
            copies[min(closing)[2]] += 1
    return copies


@pytest.mark.parametrize("by_size", [0.5, 0.0, 1.0])
def test_documents_taken_against_a_plain_sort(spark, by_size):
    sf = "/root/testdata/sf0.01"
    sizes = durable(mixing.sized(spark.read.parquet(f"{sf}/documents.parquet")), "sizes")
    if by_size == mixing.BY_SIZE:
        found = {r.doc_id: r.taken // r.size if r.size else 0 for r in queries.op7_mixing(spark, sf).collect()}
    else:
        mixed = mixing.mixed(sizes, mixing.mix(sizes, by_size=by_size), by_size=by_size)
        found = {r.doc_id: r.copies for r in mixed.collect()}
    rows = sizes.withColumn("u", unit(sizes["doc_id"])).collect()
    assert found == plain_mix([tuple(r) for r in rows], by_size)


def test_one_document_holds_most_of_a_source(spark):
    """It is certain, and the others keep their chance of what it leaves."""
    docs = documents(spark, [(0, "w " * 3_000, "a")] + [(i, "w " * 5, "a") for i in range(1, 201)] + [(1_000, "w " * 3_100, "b")])
    rows = mixed(docs)
    by_id = {r.doc_id: r.copies for r in rows}
    assert by_id[0] == 2 and {by_id[i] for i in range(1, 201)} == {1, 2}
    check(rows, lambda s: {"a": 5, "b": 60}[s])


def test_chances_grow_with_size(spark):
    docs = documents(spark, [(i, "w " * (10 if i % 2 else 90), "a") for i in range(6_000)])
    taken = defaultdict(int)
    for r in mixed(docs):
        taken[r.size] += r.copies - 1
    assert taken[90] / taken[10] == pytest.approx((90 / 10) ** mixing.BY_SIZE, abs=0.3)
