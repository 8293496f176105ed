from __future__ import annotations

import base64
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from forktide.llm import byte_pairs, queries
from forktide.llm.byte_pairs import BytePairs, PairTable, decoded, encoded

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = [
    " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "\xa0", "'", "s", "re", "ll", "a", "é", "Ü", "12", "½", "中",
    "文字", "😀", "<|endoftext|>", "!", "-", "the", "​", "\r\n", "abc", "XYZ",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(PATH)


def ids_of(pairs, texts):
    return [np.frombuffer(b"".join(parts), np.uint32).tolist() for parts in pairs.encode(texts)]


def test_random_texts_agree_with_the_library(pairs, library):
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 300 if k % 40 == 0 else 15))) for k in range(4_000)]
    for text, ids in zip(texts, ids_of(pairs, texts), strict=True):
        assert ids == library.encode_ordinary(text), text
        assert pairs.decode(np.array(ids, np.uint32).tobytes()) == text.encode()


def test_long_words_agree_with_the_library(pairs, library):
    r = random.Random(2)
    texts = [
        "a" * 5_000, "ab" * 3_000, "".join(r.choice("abcdefghij") for _ in range(20_000)), "中文" * 2_000,
        "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(3_000)), " " * 5_000 + "x", "=-" * 1_000, "é" * 257,
        *["x" + "the" * n for n in range(80, 90)], "",
    ]
    assert ids_of(pairs, texts) == [library.encode_ordinary(t) for t in texts]


def test_small_groups_parts_stores_and_matrices(library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "GROUP", 40)
    monkeypatch.setattr(byte_pairs, "PART_WORDS", 3)
    monkeypatch.setattr(byte_pairs, "KEPT_WORDS", 5)
    monkeypatch.setattr(byte_pairs, "LONGEST_KEPT", 6)
    monkeypatch.setattr(byte_pairs, "CELLS", 64)
    pairs, r = BytePairs(PATH), random.Random(3)
    texts = [" ".join(r.choice(["internationalisation", "ab", "théâtre", "x" * 300]) for _ in range(r.randint(0, 12))) for _ in range(60)]
    assert ids_of(pairs, texts) == [library.encode_ordinary(t) for t in texts]


def test_rounds_and_queue_merge_alike(pairs):
    r = random.Random(4)
    words = ["".join(r.choice("etaoin shrdlu") for _ in range(r.randint(2, 60))).encode() for _ in range(500)]
    assert pairs._rounds(words, 64) == [pairs._queued(w) for w in words]


def test_pair_table():
    r = np.random.default_rng(5)
    keys = np.unique(r.integers(0, 500, (2_000, 2)), axis=0).astype(np.int32)
    table = PairTable(keys[:, 0], keys[:, 1], np.arange(len(keys), dtype=np.int32))
    known = {tuple(k): i for i, k in enumerate(keys.tolist())}
    a, b = (x.ravel().astype(np.int32) for x in np.meshgrid(np.arange(-1, 500), np.arange(-1, 500)))
    wanted = [known.get(k, byte_pairs.NONE) for k in zip(a.tolist(), b.tolist())]
    assert table.find(a, b).tolist() == wanted


def test_rows(documents, library):
    texts = [None, "", "the cat", "the cat", "naïve <|endoftext|> 中文", "word " * 50_000]
    docs = documents(texts, keys=[1, 2, 3, 3, None, 5]).selectExpr("*", "'x' as ids", "1 as n_tokens")
    rows = encoded(docs, PATH)
    got = {tuple(r[:4]) + (tuple(r[4]),) for r in rows.collect()}
    wanted = set()
    for k, t in zip([1, 2, 3, 3, None, 5], texts):
        ids = library.encode_ordinary(t or "")
        hashes = sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest()
        wanted.add((k, len(ids), *hashes, tuple(ids)))
    assert got == wanted and rows.count() == 6
    back = sorted(((r[0] or 0), r[1]) for r in decoded(rows, PATH).collect())
    assert back == sorted(((k or 0), t or "") for k, t in zip([1, 2, 3, 3, None, 5], texts))
    assert encoded(docs.limit(0), PATH).count() == 0


def test_query_agrees_with_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha256(texts[r["doc_id"]].encode()).hexdigest()
