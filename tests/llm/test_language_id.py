from __future__ import annotations

import math
from collections import Counter

import numpy as np

from forktide.llm import language_id as li
from tests.llm.conftest import prose


def brute(text: bytes, sample: list[bytes]) -> float:
    """Bits of a text's own bytes by PPM method C, context by context."""
    counts: dict[tuple, Counter] = {}
    for t in sample:
        s = [32] * li.ORDER + list(t)
        for i in range(li.ORDER, len(s)):
            for o in range(li.ORDER + 1):
                counts.setdefault(tuple(s[i - o : i]), Counter())[s[i]] += 1
    s, bits = [32] * li.ORDER + list(text), 0.0
    for i in range(li.ORDER, len(s)):
        for o in range(li.ORDER, -2, -1):
            if o < 0:
                bits += math.log2(256)
                break
            c = counts.get(tuple(s[i - o : i]))
            if not c:
                continue
            total = sum(c.values()) + len(c)
            if c[s[i]]:
                bits -= math.log2(c[s[i]] / total)
                break
            bits -= math.log2(len(c) / total)
    return bits


def test_code_lengths_agree_with_brute_force(monkeypatch):
    monkeypatch.setattr(li, "SLICE_BYTES", 50)  # texts are cut into slices
    sample = [(lang, prose(s, 30, lang).encode()) for lang in ("en", "de") for s in range(4)]
    trees = li.learn(sample)
    sample += [("en", "PLAIN 12 Text, été".encode()), ("ru", "и это не Русский ёж".encode()), ("zh", "中文字中文".encode())]
    trees = li.learn(sample)
    texts = [b"", b"x", prose(9, 40).encode(), "Это ёж. 中文文字 Plain PLAIN 21".encode(), bytes(range(256)), "Über 12 Straßen".encode(), prose(8, 3, "de").encode()]
    got = li.code_lengths(texts, trees)
    for i, text in enumerate(texts):
        for k, lang in enumerate(trees.languages):
            want = brute(text, [t for known, t in sample if known == lang])
            assert abs(got[i, k] - want) < 1e-3 * max(1, want)


def test_predictions(documents):
    langs = ["en", "de"] * 60
    train = documents([prose(i, 40, lang) for i, lang in enumerate(langs)], langs)
    trees = li.learn_from(train)
    texts = [prose(1_000 + i, 25, lang) for i, lang in enumerate(langs)] + [None, "", "12 +", "ein", "ж"]
    docs = documents(texts, langs + [None] * 5).selectExpr("*", "1 as score")
    rows = {r["doc_id"]: r for r in li.predict(docs, trees).collect()}
    right = sum(rows[i]["lang_pred"] == lang for i, lang in enumerate(langs))
    assert right >= 0.97 * len(langs)
    assert [rows[120 + i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert rows[124]["lang_pred"] in ("de", "en")
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    kept = {r["doc_id"] for r in li.accepted(docs, trees).collect()}
    assert kept.isdisjoint({120, 121, 122}) and len(kept) >= 118


def test_no_training_rows(documents):
    docs = documents(["a text", None], langs=[None, None])
    trees = li.learn_from(docs)
    assert trees is None
    assert [r["lang_pred"] for r in li.predict(docs, trees).collect()] == ["und", "und"]
    assert li.accepted(docs, trees).count() == 0
    assert li.predict(docs.limit(0), li.learn([("en", b"a")])).count() == 0
    assert li.code_lengths([b"ab", b""], li.learn([("en", b""), ("de", b"")])).tolist() == [[16.0, 16.0], [0.0, 0.0]]


def test_confidence_is_that_of_bounded_evidence():
    bits = np.array([[10.0, 20.0], [1_000.0, 3_000.0]])
    got = li.confidence(bits, np.array([10, 100_000]))
    assert abs(got[0] - 1 / (1 + 2**-10)) < 1e-9 and got[1] < 0.7


def test_scripts_of_many_bytes_are_told_apart():
    """Four scripts of two and three bytes a letter; the languages of a pair share their script."""
    words = {
        "ru": "что это был как они все его она так уже если время люди жизнь слово".split(),
        "uk": "що це був як вони усі його вона так уже якщо час люди життя слово".split(),
        "el": "και το να που με για από είναι δεν στο τον αυτό ότι ήταν".split(),
        "hi": "और है के में की यह वह था हैं नहीं एक लिए कर साथ".split(),
        "ne": "र छ को मा हो यो त्यो थियो छन् छैन एक लागि गर्न सँग".split(),
        "zh": "我们 这个 时候 他们 什么 知道 没有 现在 可以 就是 因为 自己".split(),
    }
    r = np.random.default_rng(5)

    def text(lang: str) -> bytes:
        return " ".join(r.choice(words[lang], 30)).encode()

    trees = li.learn([(lang, text(lang)) for lang in words for _ in range(20)])
    held_out = [(lang, text(lang)) for lang in words for _ in range(20)]
    best = li.code_lengths([t for _, t in held_out], trees).argmin(1)
    assert [trees.languages[b] for b in best] == [lang for lang, _ in held_out]
