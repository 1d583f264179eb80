"""Counts against the tokenizer's own library, and what the cache spares."""

from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clearwell.llm import token_counts as tc
from clearwell.llm.queries import QUERIES
from clearwell.session import new_folder


def by_library(file):
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        return lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    tokenizer = Tokenizer.from_file(path)
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)


TEXTS = [
    "Plain words, and more.", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "  two  blanks\n\n\tand\r\n", "Größe niño",
    "这是中文", "मानक हिन्दी", "１２３ ⅷ ²", "é ​﻿", "😀 👩‍👩‍👧", "\u0085 x", "x" * 5000, "", "ǅ ᾳ",
]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(documents, file):
    count = by_library(file)
    rows = [*enumerate(TEXTS), (100, None), (0, TEXTS[0]), (None, TEXTS[1])]
    got = tc.token_counts(documents(rows), file=file, limit=5).collect()
    wanted = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 5) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_only_distinct_misses_are_encoded(documents, llm):
    cache = new_folder(llm, "test-cache")
    tc.token_counts(documents([(1, "a b"), (2, "a b"), (3, "c")]), cache)
    stored = tc.read_cache(llm, cache)
    assert stored.count() == 2
    tc.token_counts(documents([(4, "c"), (5, "d"), (6, None)]), cache)
    assert stored.sparkSession.read.schema(tc.CACHE_SCHEMA).parquet(cache).count() == 4
    # Another tokenizer has counts of its own.
    tc.token_counts(documents([(1, "c")]), cache, file="piece_bpe_32k.model")
    assert llm.read.schema(tc.CACHE_SCHEMA).parquet(cache).count() == 5


def test_stored_counts_are_used(documents, llm):
    cache = new_folder(llm, "test-cache")
    tc.token_counts(documents([(1, "known")]), cache)
    false = tc.read_cache(llm, cache).selectExpr("content", "tokenizer", "n_bytes", "n_tokens + 70 AS n_tokens")
    path = new_folder(llm, "test-cache")
    false.write.parquet(path)
    assert tc.token_counts(documents([(1, "known")]), path).first()["n_tokens"] > 70


def test_a_repeated_append_changes_nothing(documents, llm):
    cache = new_folder(llm, "test-cache")
    docs = documents([(1, "one"), (2, "two")])
    before = sorted(map(tuple, tc.token_counts(docs, cache).collect()))
    llm.read.parquet(cache).write.mode("append").parquet(cache + "-copy")
    llm.read.parquet(cache).write.mode("append").parquet(cache + "-copy")
    assert sorted(map(tuple, tc.token_counts(docs, cache + "-copy").collect())) == before


def test_empty_table(documents):
    assert tc.token_counts(documents([])).count() == 0


def test_query_equals_the_library(llm):
    folder = "/root/testdata/sf0.001"
    count = by_library("byte_bpe_50k.json")
    texts = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op5_token_counts"](llm, folder).collect():
        assert r["n_tokens"] == count(texts[r["doc_id"]])
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 512)
