from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from forktide.llm.token_counts import PrefixCounter, prefix_counts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "\xa0", "'", "s", "re", "ll", "a", "é", "Ü", "12", "½", "中",
    "😀", "<|endoftext|>", "!", "-", "the", "​", "\r\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_all_prefixes_agree_with_the_library(library):
    counter, r = PrefixCounter(PATH), random.Random(1)
    for _ in range(1_500):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 10)))
        counts = counter.prefixes(text)
        assert counter.count(text) == counts[-1]
        i = r.randint(0, len(text))
        assert counts[i] == len(library.encode(text[:i], add_special_tokens=False).ids), (text, i)
        budget = r.randint(0, 8)
        assert counter.longest_within(text, budget) == max(i for i, n in enumerate(counts) if n <= budget)


def test_long_words_and_small_stores(library, monkeypatch):
    import forktide.llm.token_counts as tc

    monkeypatch.setattr(tc, "KEPT_WORDS", 2)
    monkeypatch.setattr(tc, "KEPT_PAIRS", 3)
    counter = PrefixCounter(PATH)
    for text in ("a" * 20_000, "one two three four one two", "x" * 30 + " " + "yz" * 500):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_rows(documents):
    docs = documents([None, "", "the cat", "the cat", "a b c d e f"], keys=[1, 2, 3, 3, None])
    docs = docs.selectExpr("*", "'x' as n_tokens")
    got = {tuple(r) for r in token_counts(docs, PATH, budget=3).collect()}
    assert got == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 7, 2, 7), (None, 11, 6, 5)}
    rows = {r["doc_id"]: r["prefix_tokens"] for r in prefix_counts(docs, PATH).collect()}
    assert rows[1] == [0] and rows[3][-1] == 2 and len(rows[3]) == 8
    assert token_counts(docs.limit(0), PATH).count() == 0
