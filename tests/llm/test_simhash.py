from __future__ import annotations

import random

import numpy as np
import xxhash

from feedarb.llm import components, simhash
from tests.llm.rows import AWKWARD, documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_fingerprints():
    for text in ("", None, " \n", "One", "one TWO", "a b c", "a b c d e f g a b c", "É é x " * 50):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3_000))
    want = plain_fingerprint(text)
    whole = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: whole(data, 50))
    assert simhash.fingerprint(text) == want


def some_prints(draw, count):
    found = set()
    while len(found) < count:
        if found and draw.random() < 0.6:
            value = draw.choice(sorted(found))
            for _ in range(draw.randint(1, 3)):
                value ^= 1 << draw.randrange(64)
        else:
            value = draw.getrandbits(64)
        found.add(value)
    return sorted(found)


def test_index_finds_what_a_scan_finds():
    draw = random.Random(5)
    prints = np.array(some_prints(draw, 700), np.uint64)
    index = simhash.GrayIndex(prints)
    for value in prints[:200]:
        near = set(index.prints[index.search(value, 2)].tolist())
        assert near == {int(p) for p in prints if int(p ^ value).bit_count() <= 2}


def test_components_of_links(spark):
    draw = random.Random(6)
    prints = some_prints(draw, 500) + [0]
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2]
    want = plain_components(prints, pairs)
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    for group in (simhash.GROUP, 1):  # the second deals every shared band once more
        edges = simhash.links(spark.createDataFrame(rows, "fp long"), group=group).collect()
        got = plain_components(prints, [(r.a % 2**64, r.b % 2**64) for r in edges])
        assert got == want


def test_distributed_components(spark):
    draw = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(1000, draw.randrange(1001, 1100)) for _ in range(200)] + [(5, 5), (7, None)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    real = [(a, b) for a, b in edges if b is not None and a != b]
    want = plain_components({n for e in real for n in e}, real)
    assert {r.node: r.component for r in found} == want and len(found) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    found = simhash.near_duplicates(documents(spark, AWKWARD)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 1), (2, 1), (5, 1), (3, 3), (4, 3), (4, 3), (None, None), (6, 6), (7, 7), (8, 8)], key=str
    )
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_registered_query(spark):
    from feedarb.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = plain_components(prints, pairs)
    rows = queries.op3_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
