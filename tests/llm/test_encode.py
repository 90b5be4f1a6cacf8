import os

import pytest
from pyspark.sql import functions as F

from corploom.llm import p7_encode as P7

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(P7.TOKENIZERS, "byte_bpe_50k.json")), reason="no vocabulary files")
TEXTS = ["Hello, world!", "", None, "   ", "l'été à 5 %\n\n  fin ", "<|endoftext|>", "日本語とไทย", "a" * 700, "\x00 ​﻿ x", "I've DON'T it's", "tab\t\ttab \r\n", "😀 é", "1234567890" * 20, "same", "same"]


def test_like_the_public_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(P7.TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    docs = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS)], "doc_id long, text string, ids string")
    for head in (P7.HEAD_WORDS, 3):  # words outside the head are folded in place
        got = {r["doc_id"]: r["ids"] for r in P7.encode_corpus(docs, head_words=head).collect()}
        assert got == {i: t.encode(x, add_special_tokens=False).ids if x else [] for i, x in enumerate(TEXTS)}
    back = {r["doc_id"]: r["text"] for r in P7.decode_corpus(P7.encode_corpus(docs)).collect()}
    assert back == {i: x or "" for i, x in enumerate(TEXTS)}
    assert P7.encode_corpus(docs.limit(0)).count() == 0


def test_other_id_and_text_columns(spark):
    df = spark.createDataFrame([(7, "abc")], "k long, t string")
    assert P7.encode_corpus(df, "k", "t").first()["k"] == 7


def test_words(spark):
    df = spark.createDataFrame([("it's  a b",)], "t string")
    assert df.select(P7.words_of(F.col("t"))).first()[0] == ["it", "'s", " ", " a", " ", "b"]
