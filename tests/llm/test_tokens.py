"""Problem 8: against the public tokenizer itself, and an exact round trip."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from workloom.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.DEFAULT_VOCABULARY), reason="no vocabulary")
HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "\n\n", "a\r\n\r\nb", "it's  we'll", "<|endoftext|>", "x<|endoftext|>y", "\x00\x1c\x85 \xa0x", "　漢字 カナ", "😀 👩‍👩‍👧", "é́ ़", "1² Ⅷ ٣", "a" * 5000, " " * 3000 + "x",
    "word " * 20000, "​ ﻿", "ａ", "tab\tb \t c", "don't'll", "a\n", "\na b", "a  ",
]


@pytest.fixture(scope="module")
def public():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.DEFAULT_VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PRETOKEN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.sentencepiece_model(tokens.read_ranks(tokens.DEFAULT_VOCABULARY)))


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(encoder, public, text):
    want = public.encode_ordinary(text)
    assert encoder.encode(text) == want and encoder.count(text) == len(want)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\rab'sé漢1.,\xa0 😀<|>"), max_size=30) | st.text(max_size=20))
def test_any_text(encoder, public, text):
    assert encoder.encode(text) == public.encode_ordinary(text)


def test_small_memory_gives_the_same(encoder, public, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 2)
    small = tokens.Encoder(tokens.sentencepiece_model(tokens.read_ranks(tokens.DEFAULT_VOCABULARY)))
    text = "some words that are more than two, some words again"
    assert small.encode(text) == public.encode_ordinary(text) and small.count(text) == len(small.encode(text))


def test_frames(spark, public):
    rows = [(k, x, "old") for k, x in enumerate(HARD)] + [(99, None, "old"), (99, None, "old")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = tokens.encode_corpus(df)
    assert got.columns == ["doc_id", "ids"]
    ids = {r.doc_id: r.ids for r in got.collect()}
    assert ids[0] == ids[99] == [] and got.count() == len(rows)
    assert all(ids[k] == public.encode_ordinary(x) for k, x in enumerate(HARD))
    counted = tokens.count_tokens(df.withColumn("n_tokens", F.lit(5)))
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {k: len(v) for k, v in ids.items()}
    back = {r.doc_id: r.text for r in tokens.decode_corpus(got).collect()}
    assert all(back[k] == x for k, x in enumerate(HARD))
    assert tokens.encode_corpus(df.limit(0)).isEmpty()
