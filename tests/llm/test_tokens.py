from __future__ import annotations

import public_tokenizers
from cases import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spreadlab.llm import tokens
from spreadlab.llm.queries import op7_token_count

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokens.PrefixCounter(PATH, PATTERN)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_whole_table(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op7_token_count(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 512)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeinrst \n<|>'0.")), max_size=60))
def test_any_text(text):
    assert COUNTER.count(text) == library(text)
    assert (COUNTER.prefix_counts(text) or [0])[-1] == library(text)


def test_prefixes_within_a_chunk():
    for word in (" understanding", "Wörterbuch", "aaaaaaaaaaaaaaaaaaaaaaaa", " 1234567890123", "日本語日本語"):
        for k, n in enumerate(COUNTER.prefix_counts(word), 1):
            assert n == library(word[:k])


def test_special_strings_and_budget():
    text = "one two<|endoftext|>three  <|endoftext|>"
    assert COUNTER.count(text) == library(text)
    counts = COUNTER.prefix_counts(text)
    assert len(counts) == len(text) and counts[-1] == library(text)
    cut = COUNTER.longest_prefix("hello there my friend", 2)
    assert "hello there my friend"[:cut] == "hello there"
    assert COUNTER.longest_prefix("hello", 0) == 0


def test_awkward_rows(spark):
    rows = {r["doc_id"]: r for r in tokens.count_tokens(awkward(spark, clashing=True), PATH, PATTERN).collect()}
    assert rows[2]["n_tokens"] == rows[3]["n_tokens"] == 0 and rows[5]["over_limit"]
    assert tokens.count_tokens(empty(spark), PATH, PATTERN).count() == 0
    cuts = {r["doc_id"]: r for r in tokens.budget_cuts(awkward(spark), PATH, PATTERN, 5).collect()}
    assert cuts[5]["cut_tokens"] <= 5 and cuts[2]["cut_text"] == ""
