from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedarb.llm import queries, token_counts
from tests.llm.rows import AWKWARD, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


def library(texts):
    whole = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_registered_query_equals_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.queries()["op13_token_counts"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    want = dict(zip(docs, library(docs.values())))
    for r in rows:
        assert (r.n_tokens, r.n_bytes) == (want[r.doc_id], len((docs[r.doc_id] or "").encode()))
        assert r.over_limit == (r.n_tokens > 2048)


def test_odd_texts_equal_the_library():
    random.seed(5)
    bits = [
        "it's", "<|endoftext|>", "<|startoftext|>", "a<|endoftext|>b", " ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c",
        "\x85", " ", " ", " ", "é", "́", "ΟΔΟΣ", "İ", "ﬁ", "漢字", "한", "한",
        "12", "½", "_", "...", "\U0001f600", "\x00", "don'T", "'", "‍", "ǅ", "x" * 80,
    ]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 12))) for _ in range(4000)]
    own = token_counts.TokenCounter(PATH)
    assert own.by_word
    own.use((b"it's ...", b"\x02\x00\x01\x00"))
    assert [own.count(t.encode()) for t in texts] == library(texts)


def test_a_cache_that_starts_over_counts_alike(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 2000)
    random.seed(6)
    texts = [" ".join(random.choice("abcdefgh") * random.randint(1, 90) for _ in range(60)) for _ in range(80)]
    own = token_counts.TokenCounter(PATH)
    own.use((b"a b", b"\x01\x00\x01\x00"))
    assert [own.count(t.encode()) for t in texts] == library(texts)
    assert own._held < 2000 + 250


def test_the_table_is_bounded_and_holds_the_most_frequent(spark):
    docs = documents(spark, [(i, "often often rare%d %s" % (i, "w" * 100), "a") for i in range(50)])
    words, lengths = token_counts.frequent(docs, PATH, most=5)
    assert words.split()[0] == b"often" and len(words.split()) == 5 and len(lengths) == 10
    assert b"w" * 100 not in words


def test_other_tokenizers_count_whole_texts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["two  blanks\n and more", "", None, "<s> x </s>"]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = token_counts.counted(documents(spark, [(i, t, "a") for i, t in enumerate(texts)]), path).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(model.encode(t or "")) for i, t in enumerate(texts)}
    multi = public_tokenizers.path("byte_bpe_50k.json")
    assert not token_counts.TokenCounter(multi).by_word


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_rows_and_empty_table(spark, rows):
    got = token_counts.counted(documents(spark, rows), PATH).collect()
    want = library([t for _, t, _ in rows])
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted(
        (i or -1, len((t or "").encode()), n) for (i, t, _), n in zip(rows, want)
    )
