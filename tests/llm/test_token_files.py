from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from feedarb.llm import token_files
from feedarb.plans import storage
from tests.llm.rows import AWKWARD, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(library):
    own = token_files.word_encoder(PATH)
    draw = random.Random(1)
    signs = "abcS  \n\t'sé漢\U0001f60012  \r\x1c\x85.,###aaaÁſΣΟİ́e'"
    for _ in range(400):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) + draw.choice(["", " foo<|endoftext|>bar "])
        words = token_files.words_of(text)
        own.learn(set(words))
        assert np.frombuffer(own.encode(words), "<u4").tolist() == library(text)


def test_texts_in_bulk_give_the_ids_of_the_library(library, monkeypatch):
    monkeypatch.setattr(token_files, "GATHERED_WORDS", 7)
    own = token_files.WordEncoder(PATH)
    own._known.most = 20  # remembered words change often
    draw = random.Random(4)
    letters = "".join(c for c in map(chr, range(256)) if c.isalpha())
    signs = letters + "abcS  \n\t'sé漢\U0001f60012  \r\x1c\x85.,###ſΣΟİ́e'"
    texts = ["", None, " ", "\n\n", " ".join(letters), letters, "x" * 100 + ".", "It's, 'tis. l'Été!", "<|ENDOFTEXT|>, a<|endoftext|>."]
    for _ in range(300):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 40)))
        texts.append(" ".join(draw.choice([w, w.upper(), w.title() + draw.choice(",.;)")]) for w in text.split(" ")))
    column = pa.array(["not read", *texts])[1:]
    for at in range(0, len(texts), 50):
        ids, sizes = own.encode_texts(column[at : at + 50], 2)
        want = [[*library(text or ""), 2] for text in texts[at : at + 50]]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_a_plain_word_reaches_the_library_once():
    own = token_files.WordEncoder(PATH)
    asked, others, bulk, single = [], [], own._in_bulk, own._by_library
    own._in_bulk = lambda words: asked.extend(words) or bulk(words)
    own._by_library = lambda words: others.extend(words) or single(words)
    own.learn({"Zörgel", "zörgel,", "ZÖRGEL", "zörgel.", "qwert"})
    own.learn({"Qwert.", "zörgel", "QWERT,"})
    assert sorted(asked) == ["qwert", "zörgel"]
    assert set(others) == {",", "."}
    long = "9" * 1000
    assert own.encode([long, "qwert"]) == single([long])[0] + own.encode(["qwert"])
    assert long not in own._known and "qwert" in own._known


def test_last_turns_look_only_where_frequent_pairs_can_be(monkeypatch):
    draw = np.random.default_rng(6)
    ids = (3_000 * draw.random(100_000) ** 4).astype("u4")
    turns, last_heads, frequent = [], token_files._last_heads, token_files._frequent

    def watched(seq, least, shift, *ends):
        looked = []
        monkeypatch.setattr(token_files, "_frequent", lambda pairs, n: looked.append(len(pairs)) or frequent(pairs, n))
        out = last_heads(seq, least, shift, *ends)
        monkeypatch.setattr(token_files, "_frequent", frequent)
        every, _ = frequent(seq[:-1] << seq.dtype.type(shift) | seq[1:], least)
        turns.append((looked[0], len(seq), out[1].tolist() == every.tolist()))
        return out

    monkeypatch.setattr(token_files, "_last_heads", watched)
    grammar = token_files.compress(ids, 3_000)
    assert grammar.decode() == ids.astype("<u4").tobytes()
    assert len(turns) > 4 and all(same for _, _, same in turns)
    assert all(looked < size / 2 for looked, size, _ in turns[len(turns) // 2 :])


@pytest.mark.parametrize("ids", [[], [5], [0] * 1000, [1, 2] * 500, [3, 3, 3, 4] * 100, list(range(9)) * 50])
def test_grammar_round_trip(ids):
    grammar = token_files.compress(np.array(ids, "u4"), 10)
    assert grammar.decode() == np.array(ids, "<u4").tobytes()
    assert len(ids) < 100 or len(grammar.symbols) < len(ids) / 5
    draw = random.Random(2)
    for _ in range(50):
        first = draw.randint(0, len(ids))
        end = draw.randint(first, len(ids))
        assert grammar.between(first, end) == ids[first:end]


def test_wide_symbols():
    draw = np.random.default_rng(3)
    ids = draw.choice(np.array([7, 70_000, 150_000]), 5_000).astype("u4")
    grammar = token_files.compress(ids, 200_000)
    assert grammar.decode() == ids.astype("<u4").tobytes() and len(grammar.symbols) < len(ids)


def digests(spark, docs, block):
    path = storage.new_path(spark, "token-files")
    token_files.write(docs, path, PATH, 2, block)
    return token_files.read_digests(spark.read.parquet(path)).collect()


@pytest.mark.parametrize("block", [100, token_files.BLOCK_TOKENS])
def test_files_read_back(spark, library, block):
    docs = documents(spark, AWKWARD).repartition(3)
    got = sorted(tuple(r) for r in digests(spark, docs, block) if r.doc_id is not None)
    start, want = len(library("no id at all")) + 1, []
    for doc_id, text, _ in sorted((r for r in AWKWARD if r[0] is not None), key=lambda r: r[0]):
        ids = [*library(text or ""), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_empty_table(spark):
    assert digests(spark, documents(spark, []), 100) == []


def pairs_left(symbols):
    """The most occurrences, without overlaps, of a pair of neighbours."""
    counts, last = {}, {}
    for at, pair in enumerate(zip(symbols, symbols[1:])):
        if last.get(pair, -2) < at - 1:
            counts[pair] = counts.get(pair, 0) + 1
            last[pair] = at
    return max(counts.values(), default=0)


@pytest.mark.parametrize("size", [5_000, 70_000, 300_000])
@pytest.mark.parametrize("base", [3_000, 100_000])
def test_grammar_ends_when_no_pair_is_frequent(size, base):
    draw = np.random.default_rng(size)
    ids = (base * draw.random(size) ** 4).astype("u4")
    for _ in range(size // 40):  # repeated passages
        a, b = draw.integers(0, size - 12, 2)
        ids[a : a + 12] = ids[b : b + 12]
    ids[size // 2 : size // 2 + 700] = 7
    grammar = token_files.compress(ids, base)
    assert grammar.decode() == ids.astype("<u4").tobytes()
    assert pairs_left(grammar.symbols.tolist()) < 8 or len(grammar.rules) == (1 << 16) - (base if base < 60_000 else 0)


def test_frequent_pairs_as_counted():
    draw = np.random.default_rng(4)
    for size, least in ((0, 1), (5, 8), (3_000, 1), (3_000, 8), (3_000, 40), (8, 8)):
        pairs = (60 * draw.random(size) ** 2).astype("u4")
        found, counts = np.unique(pairs, return_counts=True)
        got, times = token_files._frequent(pairs, least)
        assert got.tolist() == found[counts >= least].tolist()
        assert times.tolist() == counts[counts >= least].tolist()
