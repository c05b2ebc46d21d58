from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from feedarb.llm import sharding
from tests.llm.rows import AWKWARD, documents


def test_tree_takes_the_tightest():
    draw = random.Random(1)
    tree, plain = sharding.CapacityTree(), []
    for shard in range(400):
        if plain and draw.random() < 0.5:
            size = draw.randint(0, 60)
            fits = sorted(x for x in plain if x[0] >= size)
            found = tree.take(size)
            assert found == (fits[0] if fits else None)
            if found:
                plain.remove(found)
        capacity = draw.randint(0, 50)
        tree.insert(capacity, shard)
        plain.append((capacity, shard))


def test_best_fit_decreasing_is_the_plain_rule():
    draw = random.Random(2)
    items = [(draw.randint(1, 60), i) for i in range(300)]
    left, placed = [], {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        fits = [s for s in range(len(left)) if left[s] >= size]
        shard = min(fits, key=lambda s: (left[s], s)) if fits else len(left)
        if not fits:
            left.append(100)
        left[shard] -= size
        placed[item] = shard
    sizes = dict((item, size) for size, item in items)
    want = Counter((sizes[item], shard) for item, shard in placed.items())
    got = Counter()
    for size, shard, count in sharding.best_fit_decreasing(Counter(sizes.values()).items(), 100):
        got[size, shard] += count
    assert got == want


def test_packing_of_classes_is_the_plain_rule_at_any_capacity():
    draw = random.Random(5)
    for _ in range(300):
        sizes = [draw.choice((8, 9, 13, 40, 41, 77)) for _ in range(draw.randint(1, 80))]
        shards = draw.randint(1, 9)
        dealt = sharding.pack(Counter(sizes).items(), shards)
        assert Counter({s: sum(n for t, _, n in dealt if t == s) for s in set(sizes)}) == Counter(sizes)
        used = Counter()
        for size, shard, count in dealt:
            used[shard] += size * count
        assert set(used) <= set(range(shards))
        assert max(used.values()) <= max(max(sizes), -(-sum(sizes) // shards)) + max(sizes)


def judge(rows, texts, shards):
    used, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data) and 0 <= r.shard < shards
        used[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    return used


def test_documents_in_24_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    used = judge(sharding.sharded(docs, 24).collect(), texts, 24)
    assert len(used) == 24 and max(used.values()) - min(used.values()) < 0.01 * sum(used.values()) / 24


def test_a_group_above_an_equal_share(spark):
    rows = [(i, "copy " * 20 if i < 300 else f"text {i}", "a") for i in range(900)]
    used = judge(sharding.sharded(documents(spark, rows), 8).collect(), {i: t for i, t, _ in rows}, 8)
    small = sorted(used.values())[:-1]
    assert len(used) == 8 and small[-1] - small[0] <= 64


def test_one_size_over_many_blocks_and_heavy_texts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PLACE_ROWS", 50)
    monkeypatch.setattr(sharding, "HEAVY_TEXTS", 20)
    rows = [(i, f"{i:06}", "a") for i in range(3000)] + [(3000 + i, f"same {i % 3}", "b") for i in range(900)]
    rows += [(3900 + i, "x" * draw, "c") for i, draw in enumerate(random.Random(7).choices(range(1, 400), k=600))]
    docs = documents(spark, rows)
    found = sharding.sharded(docs, 6).collect()
    assert len(found) == len(rows)
    used = judge(found, {i: t for i, t, _ in rows}, 6)
    assert max(used.values()) - min(used.values()) <= 64
    again = sharding.sharded(docs.repartition(5), 6).collect()
    assert {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in found}


def test_registered_query(spark):
    from feedarb.llm import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = queries.op8_sharding(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(texts) and {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    groups = defaultdict(int)
    for text in texts.values():
        groups[text] += len((text or "").encode()) + 8
    want = Counter()
    for size, shard, count in sharding.pack(Counter(groups.values()).items(), 24):
        want[size, shard] += count
    shards = {texts[r.doc_id]: r.shard for r in found}
    assert Counter((groups[t], s) for t, s in shards.items()) == want
    judge(found, texts, 24)


def test_awkward_rows(spark):
    rows = sharding.sharded(documents(spark, AWKWARD), 3).collect()
    assert len(rows) == len(AWKWARD)
    judge(rows, {i: t for i, t, _ in AWKWARD}, 3)
    assert sharding.sharded(documents(spark, []), 3).count() == 0
