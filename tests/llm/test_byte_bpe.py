from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from feedarb.llm import byte_bpe, shared
from tests.llm.rows import AWKWARD, documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(text):
    return np.frombuffer(byte_bpe.codec(RANKS, public_tokenizers.PATTERN).encode(text), np.int32).tolist()


def test_equals_the_library_on_random_texts(library):
    draw = random.Random(1)
    signs = "abc  \n\t'sé漢\U0001f60012  \r\x1c\x85.,###aaaáſ<|endoftext|>"
    for _ in range(500):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 60)))
        assert ids(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, "= " * 500, " ", "a  ", "\n\n  b", "thehe" * 5_000])
def test_long_pieces(library, text):
    assert ids(text) == library.encode_ordinary(text)


def test_backtracking_equals_plain_merges():
    codec = byte_bpe.BytePairCodec(
        {**{bytes([b]): b for b in range(256)}, b"ab": 256, b"bc": 257, b"abc": 258, b"cab": 259, b"aa": 260, b"aab": 261}, r"\S+"
    )
    draw = random.Random(2)
    for _ in range(500):
        data = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12)))
        assert codec.backtrack(data) == codec.merge(data)


def test_query_on_awkward_rows(spark, library):
    rows = byte_bpe.digests(documents(spark, AWKWARD), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(AWKWARD)
    texts = {i: t or "" for i, t, _ in AWKWARD}
    for row in rows:
        want = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_empty_table(spark):
    assert byte_bpe.digests(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["a\tb\tc\n\n", "\n\na\tb\tc", "a\tb\tc\td  e", "  a\tb\tc", "a\u00a0b\u00a0c\n\n", "a b\nc", ""])
def test_ranks_with_tokens_of_several_line_ends(text):
    import tiktoken

    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert b"\n\n" in codec.ranks
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert np.frombuffer(codec.encode(text), np.int32).tolist() == plain.encode_ordinary(text)


def test_decoding_and_memories_of_bounded_size(spark):
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    text = "x" * 5_000 + " short " + "é漢" * 900
    assert codec.decode(ids(text)) == text.encode()
    assert max(map(len, [*codec._words, *codec._inner, *codec._pieces])) <= shared.WORD_CHARS
    rows = byte_bpe.decode(byte_bpe.encode(documents(spark, AWKWARD), RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t, _ in AWKWARD)
