from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from feedarb.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, pos long, chunk long, symbol string"


def cheapest(rows):
    """Cost, audit and turns by looking for the least (cost, audit) path; rows: (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, at, shape, turns = heapq.heappop(heap)
        state = (at, shape)
        if state in seen:
            continue
        seen.add(state)
        if at == len(rows) and shape in ("", "a"):
            return cost, audit, turns

        def go(more, letter, step, role, text):
            new = shape if role is None else role[:1]
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[shape]
            if role is None or (new and new in allowed):
                said = turns if role is None else (*turns, f"{role}:{text}")
                heapq.heappush(heap, (cost + more, audit + letter, at + step, new, said))

        for role in ("user", "assistant"):
            go(5, "I", 0, role, "")
        if at < len(rows):
            role, text, fault = rows[at]
            go(2, "D", 1, None, None)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                go(extra, "K", 1, role, text)
                for new in ("user", "assistant"):
                    go(1 + extra, "R", 1, new, text)


def expected(turns):
    """From rows (conv_id, turn, role, text) as they are; per conversation id."""
    found = {}
    for conv in {r[0] for r in turns}:
        mine = sorted(
            ((t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv),
            key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), hashlib.sha256(row[2].encode()).hexdigest()),
        )
        rows, seen, counts, illegal = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}, 0
        for _, role, text in mine:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (
                "blank" if not words else "duplicate" if (role, text) in seen
                else "truncated" if words[-1] not in ".!?" else None
            )
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            rows.append((role, text, fault))
        for (a, _, _), (b, _, _) in zip(rows, rows[1:]):
            illegal += a[:1] + b[:1] not in ("su", "ua", "au")
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit, said = cheapest(rows)
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return found


def shown(rows):
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows
    }


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def some_turns(seed, convs=25, most=9):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "System", "u"]
    texts = ["Fine.", "Why?", "cut", " \t\n", "", None, "so!\x0b ", "é…", "Ok.\n", "a.b"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, most)):
            at = rng.choice([turn, turn, turn, None, turn + rng.randint(0, 3), -turn])
            rows.append((conv, at, rng.choice(roles), rng.choice(texts)))
            if rng.random() < 0.15:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("chunk_rows", [1, 3, 1 << 16])
def test_equals_search_over_all_edits(spark, chunk_rows):
    rows = some_turns(chunk_rows)
    got = repair.repaired(make(spark, rows), chunk_rows).collect()
    assert shown(got) == expected(rows)


def test_registered_query_equals_search(spark):
    sf = "/root/testdata/sf0.01"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = []
    for conv, turn, role, text in turns:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        left += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for r in turns} | expected(left)
    assert shown(queries.queries()["op12_repair"](spark, sf).collect()) == want


def test_damage_of_nulls(spark):
    rows = [(c, t, r, x) for c in (None, *range(40)) for t in (None, 1) for r, x in ((None, "Hm."), ("user", None))]
    got = sorted(map(tuple, repair.damaged(make(spark, rows)).collect()), key=repr)
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else x.replace(".", "") if kind == 2 else x)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(20))
def test_speculation_ends_in_the_plain_recursion(seed):
    rng = random.Random(seed)
    symbols = "".join(rng.choice("0123456789abcdef") for _ in range(400))
    plain = repair.left_vector(symbols, repair.END)
    parts = [symbols[i : i + 7] for i in range(0, 400, 7)]
    used = [repair.SPECULATIVE] * (len(parts) - 1) + [repair.END]
    left = [repair.left_vector(p, u) for p, u in zip(parts, used)]
    while True:
        asked = [*left[1:], repair.END]
        if asked == used:
            break
        left = [repair.fixed_up(p, u, l, r) for p, u, l, r in zip(parts, used, left, asked)]
        used = asked
    assert left[0] == plain


def test_one_conversation_with_most_rows(spark):
    turn = [("user", "Well?"), ("assistant", "Yes."), ("user", "no"), ("tool", "1."), ("assistant", "Yes.")]
    rows = [(7, i, turn[i % 5][0], f"{i} {turn[i % 5][1]}") for i in range(600)] + [(8, 0, "user", "Hi.")] * 50
    got = shown(repair.repaired(make(spark, rows), 16).collect())
    assert got == expected(rows)


def test_empty_table(spark):
    none = make(spark, [])
    assert repair.report(none, none).count() == 0
    one = repair.report(none, make(spark, [(3, 0, "user", "x")])).first()
    assert (one.conv_id, one.audit, one.cost, one.repaired_sha256) == (3, "", 0, hashlib.sha256().hexdigest())
