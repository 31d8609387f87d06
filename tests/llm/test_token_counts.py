from __future__ import annotations

import random

import numpy as np
import pytest
from regionpulse.llm import token_counts
from regionpulse.llm.bpe import vocabulary_path
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def merger():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return token_counts.Merger(file.read())


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(vocabulary_path())
    found.no_truncation()
    found.no_padding()
    return lambda text: len(found.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library_for_random_texts(merger, library):
    rng = random.Random(3)
    memory = token_counts.Memory(merger)
    texts = ["".join(rng.choice("ab eth1 \n's.éßñ中\t😀_A") for _ in range(rng.randrange(300))) for _ in range(300)]
    assert token_counts.count_texts(iter(texts), memory).tolist() == [library(t) for t in texts]


def test_runs_of_one_symbol_and_special_strings(merger, library):
    memory = token_counts.Memory(merger)
    texts = ["", None, "a" * 9_999, " " * 777, "aaaaabaaaa" * 50, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "é" * 501, "\x00\x01"]
    assert token_counts.count_texts(iter(texts), memory).tolist() == [library(t or "") for t in texts]


def test_long_texts_are_counted_by_portions(merger, library, monkeypatch):
    monkeypatch.setattr(token_counts, "PORTION", 100)
    monkeypatch.setattr(token_counts, "PIECES", 7)
    monkeypatch.setattr(token_counts, "MEMORY", 20)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdef<|") for _ in range(rng.randrange(12))) for _ in range(200)) + "<|endoftext|>x" for _ in range(5)]
    assert token_counts.count_texts(iter(texts), token_counts.Memory(merger)).tolist() == [library(t) for t in texts]


def test_sequences_are_cut_only_where_no_token_goes_on(merger):
    pieces = [b"abcabc", b"qzxjqzxj" * 40, b"a"]
    whole = merger.beside.copy()
    found = merger.counts(pieces)
    merger.beside = np.ones_like(whole)
    assert merger.counts(pieces).tolist() == found.tolist()
    merger.beside = whole


def test_a_vocabulary_out_of_order_is_refused():
    letters = token_counts.byte_letters()
    vocab = {c: k for k, c in enumerate(letters)} | {"ab": 256, "abc": 257}
    source = '{"added_tokens": [], "model": {"vocab": %s, "merges": ["ab c", "a b"]}}' % __import__("json").dumps(vocab)
    with pytest.raises(ValueError, match="merge 0"):
        token_counts.Merger(source)


def test_every_row_is_counted(docs, library):
    rows = [(1, "one two"), (1, "one two"), (None, "x" * 5000), (3, None), (4, ""), (5, "á " * 600)]
    table = docs(rows).selectExpr("*", "1 n_bytes", "2 n_tokens", "3 over_limit")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.counted(table).collect()}
    want = {(i, len((t or "").encode()), library(t or ""), library(t or "") > 512) for i, t in rows}
    assert got == want and token_counts.counted(table).count() == len(rows)
    assert token_counts.counted(docs([])).collect() == []
