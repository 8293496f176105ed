from __future__ import annotations

import random

import pytest

from forktide.llm import decontamination as dc
from tests.llm.conftest import prose


def brute(doc: str | None, item: str) -> tuple[int, int] | None:
    """Most equal words, and length, of the best stretch over all ways to lay the item on the text."""
    import re

    words = re.split(r"[^\w]+|_", (doc or "").lower())
    own = [w for w in re.split(r"[^\w]+|_", item.lower()) if w]
    best = None
    for diff in range(-len(own), len(words)):
        run, top, since, stretch = 0, 0, 0, None
        at = max(diff, 0)
        equal = [a == b for a, b in zip(words[at:], own[max(-diff, 0) :])]
        for i, e in enumerate(equal):
            if run <= 0:
                run, since = 0, i
            run += 1 if e else -3
            if run > top:
                top, stretch = run, (since, i + 1)
        if stretch:
            n, m = sum(equal[slice(*stretch)]), stretch[1] - stretch[0]
            if m >= min(dc.MIN_WORDS, len(own)) and n >= dc.MIN_SHARE * m and (best is None or (n, m) > best):
                best = (n, m)
    return best


@pytest.mark.parametrize("most", [0, 400_000])
def test_overlaps_agree_with_brute_force(spark, documents, monkeypatch, most):
    monkeypatch.setattr(dc, "BROADCAST_SEEDS", most)
    r = random.Random(4)
    items = [prose(100 + i, 12 + 4 * i) for i in range(8)] + ["only four words here", prose(100, 12)]
    texts = [None, "", items[8], prose(50, 200)]
    for period in (3, 4, 5, 7, 50):
        words = items[6].split()
        for i in range(r.randrange(period), len(words), period):
            words[i] = "changed"
        texts.append(f"{prose(period, 30)} {' '.join(words)} {prose(period + 1, 30)}")
    texts += [items[7].upper().replace(" ", ", "), " ".join(items[5].split()[8:22]), items[0] + " " + items[3], items[2]]
    texts.append(items[2])
    item_table = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(None, None)], "item_id bigint, text string")
    docs = documents(texts).selectExpr("*", "1 as n_words").union(documents([items[2]], keys=[None]).selectExpr("*", "1 as n_words"))
    got = {(r["doc_id"], r["item_id"]): (r["n_equal"], r["n_words"]) for r in dc.overlaps(docs, item_table).collect()}
    want = {(d, i): brute(t, item) for d, t in enumerate(texts) for i, item in enumerate(items)}
    want |= {(None, i): brute(items[2], item) for i, item in enumerate(items)}
    third = [k for k, v in want.items() if v]
    assert got == {k: want[k] for k in third if len(items[k[1]].split()) > 5}
    kept = {r["doc_id"] for r in dc.clean(docs, item_table).collect()}
    assert kept == set(range(len(texts))) - {k[0] for k in got}


def by_length_and_share(doc: str, item: str) -> tuple[int, int] | None:
    """Equal words and length of the longest stretch between equal words, or of the whole short item."""
    words, own, best = doc.lower().split(), item.lower().split(), None
    for diff in range(-len(own), len(words)):
        equal = [a == b for a, b in zip(words[max(diff, 0) :], own[max(-diff, 0) :])]
        windows = [(i, j) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)]
        if len(own) <= dc.MIN_WORDS:
            windows = [(0, len(equal))] if len(equal) == len(own) else []
        else:
            windows = [(i, j) for i, j in windows if j - i >= dc.MIN_WORDS and equal[i] and equal[j - 1]]
        good = [(j - i, -i, sum(equal[i:j])) for i, j in windows if sum(equal[i:j]) >= dc.MIN_SHARE * (j - i)]
        if good:
            m, _, n = max(good)
            best = max(best or (0, 0), (n, m))
    return best


def test_replaced_words_and_short_items_are_found_by_length_and_share(spark, documents):
    r = random.Random(8)
    items = [prose(300 + n, n) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 24, 40)]
    texts = ["", prose(60, 40)]
    for item in items:
        for at in range(4):
            words = item.split()
            for i in range(at, len(words), 4):
                words[i] = "changed"
            texts.append(f"{prose(70 + at, 9)} {' '.join(words)} {prose(80 + at, 9)}")
        words = item.split()
        texts += [item, " ".join(["changed", *words[1:]]) + " tail", " ".join(["head", *words[:-1], "changed"])]
        for i in r.sample(range(len(words)), len(words) // 4):
            words[i] = "other"
        if len(words) < dc.MIN_WORDS:
            texts.append(" ".join(words))
    table = spark.createDataFrame([(None if i == 6 else i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    docs = documents(texts)
    got = {(r["doc_id"], r["item_id"]): (r["n_equal"], r["n_words"]) for r in dc.overlaps(docs, table, by_share=True).collect()}
    want = {(d, None if i == 6 else i): by_length_and_share(t, x) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert got == {k: v for k, v in want.items() if v}
    assert len({i for _, i in got}) == len(items)
    kept = {r["doc_id"] for r in dc.clean(docs, table, by_share=True).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in got}


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string")
    docs = documents([prose(1, 20)])
    assert dc.overlaps(docs.limit(0), items).count() == 0
    assert dc.overlaps(docs, items.limit(0)).count() == 0
    assert dc.clean(docs, items.limit(0)).count() == 1
