import random

import pytest

from tillroll.llm import token_counts

from cases import documents, odd_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

HAND = [
    "", " ", "It's we'LL said'd ''s", "a<|endoftext|>b <|startoftext|><|startoftext|> <|EndOfText|> <|endoftext|",
    "ΑΣ ΟΔΟΣ Σ İstanbul Ǆ ﬁ é é ½ ² ٣ 中文字 😀😀 👩‍👩‍👧", "aaaa aaaaaaaaaaa!!!???... -- 12345 1a2b",
    "x\x1cy\x1d\x85z​　q﻿", "nạ̈ive", "a" * 3000, "!?" * 2000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.load_table(PATH))


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_hand_made_texts(library, counter):
    assert counter.count(HAND) == lengths(library, HAND)


def test_random_texts(library, counter):
    rng = random.Random(7)
    pool = "abcdefghijklmnopqrstuvwxyz'ABC 0123456789.,!?\n\t" + "éßüñçØŁπΩжשあ漢ﬀ"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(200))) for _ in range(2000)]
    assert counter.count(texts) == lengths(library, texts)


def test_every_character(library, counter):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert counter.count(texts) == lengths(library, texts)


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_PRE_TOKENS", 3)
    small = token_counts.Counter(token_counts.load_table(PATH))
    assert small.count(HAND) == lengths(library, HAND)


def test_operator(spark, library):
    rows = token_counts.token_counts(documents(spark, HAND), PATH).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == lengths(library, HAND)
    assert [r["n_bytes"] for r in rows] == [len(t.encode()) for t in HAND]
    assert [r["over_limit"] for r in rows] == [n > 2048 for n in lengths(library, HAND)]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = token_counts.token_counts(docs, PATH).collect()
    assert len(rows) == docs.count()
    assert {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] in (0, 1)} == {(0, 0, False)}
    assert token_counts.token_counts(odd_documents(spark, []), PATH).count() == 0
