from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from forktide.llm import class_lm as lm
from tests.llm.conftest import prose


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [None]


@pytest.mark.parametrize("most", [10, 250_000])
def test_counts_and_base_scores(documents, monkeypatch, most):
    monkeypatch.setattr(lm, "FLUSH_WORDS", 50)
    monkeypatch.setattr(lm, "FLUSH_ROWS", 20)
    monkeypatch.setattr(lm.frequency_limit, "__defaults__", (most,))
    texts = [prose(i, 30) + " The the" for i in range(20)] + [None, "", "new words\x0bhere", "ÄB äb", "A"]
    docs = documents(texts, keys=[*range(24), None]).selectExpr("*", "1 as score")
    train = docs.filter("doc_id % 3 < 2")
    counts = Counter(t for i, x in enumerate(texts[:24]) if i % 3 < 2 for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    fitted = lm.fit(train)
    rows = {r["doc_id"]: r for r in lm.score(docs, *fitted).collect()}
    for key, text in zip([*range(24), None], texts):
        row, own = rows[key], tokens(text)
        want = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert abs(row["base_score"] - want) < 1e-9 * max(1, abs(want))
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(counts[t] > 0 for t in own))
        assert row["train_tokens"] == total
    # The class model, token by token.
    _, _, table, model = fitted
    sizes = Counter()
    for t, n in counts.items():
        k = model.class_of_unit[0 if t is None else lm.FIRST_WORD + table.index[t] if t in table.index else lm.suffix_group(t)]
        sizes[k] += n + 1
    for key in (0, 5, 22):
        before, want = 0, 0.0
        for t in tokens(texts[key]):
            unit = 0 if t is None else lm.FIRST_WORD + table.index[t] if t in table.index else lm.suffix_group(t)
            k = model.class_of_unit[unit]
            want += model.log_transition[before, k] + math.log10((counts[t] + 1) / (sizes[k] + 1))
            before = k
        assert abs(rows[key]["score"] - want) < 1e-9 * abs(want)
    assert np.allclose((10**model.log_transition).sum(1), 1)


def likelihood(n, own, classes):
    def f(x):
        return (x * np.log(np.maximum(x, 1e-300))).sum()

    table = np.eye(classes)[own].T @ n @ np.eye(classes)[own]
    return f(table) - f(table.sum(0)) - f(table.sum(1))


def test_exchange_ends_where_no_single_move_helps():
    r = np.random.default_rng(1)
    for _ in range(5):
        n = r.integers(0, 30, (25, 25)).astype(float)
        own = lm.exchange(n, classes=5, sweeps=50)
        assert own[0] == 0 and (own[1:] > 0).all()
        best = likelihood(n, own, 5)
        for u in range(1, 25):
            for k in range(1, 5):
                other = own.copy()
                other[u] = k
                assert likelihood(n, other, 5) <= best + 1e-6


def test_nothing_to_learn_from(documents):
    docs = documents(["a b", None])
    rows = {r["doc_id"]: r for r in lm.score(docs, *lm.fit(docs.limit(0))).collect()}
    assert (rows[0]["n_tokens"], rows[0]["n_known"], rows[0]["train_tokens"], rows[0]["base_score"]) == (3, 0, 0, 0.0)
    assert rows[1]["n_tokens"] == 1
    assert lm.score(docs.limit(0), *lm.fit(docs)).count() == 0


def test_best_class_of_a_unit_is_that_of_the_highest_likelihood():
    r = np.random.default_rng(2)
    n = r.integers(0, 9, (20, 20)).astype(float)
    own = np.append(0, r.integers(1, 5, 19))
    for unassigned in (False, True):
        for u in range(1, 20):
            now = own.copy()
            member = np.eye(5)[now]
            if unassigned:
                now[u] = lm.UNASSIGNED
                member[u] = 0
            table = member.T @ n @ member
            got = lm.best_classes(
                (n @ member)[[u]], (n.T @ member)[[u]], n[[u], [u]], now[[u]], table
            )[0]
            tries = {}
            for k in range(1, 5):
                other = own.copy()
                other[u] = k
                tries[k] = likelihood(n, other, 5)
            assert tries[got] >= max(tries.values()) - 1e-6


def test_every_frequent_word_is_clustered_by_its_own_neighbours(documents, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", lm.FIRST_WORD + 12)
    monkeypatch.setattr(lm, "BLOCK", 64)
    # Rare names after "mr" and rare verbs after "to", all with the same last two bytes.
    r = np.random.default_rng(3)
    names, verbs = [f"n{i}xx" for i in range(40)], [f"v{i}xx" for i in range(40)]
    texts = [
        " ".join(f"the mr {r.choice(names)} said he went to {r.choice(verbs)} it ." for _ in range(40)) for _ in range(30)
    ]
    docs = documents(texts)
    _, _, table, model = lm.fit(docs)
    k = {w: int(model.class_of_unit[lm.FIRST_WORD + i]) for w, i in table.index.items()}
    of_names, of_verbs = {k[w.encode()] for w in names}, {k[w.encode()] for w in verbs}
    assert not of_names & of_verbs
    # The counts by class are those of the texts, and sweeps never lower the likelihood.
    numbers = lm.encoded(docs.select("text"), table)
    sequences = [[0, *[lm.FIRST_WORD + table.index[w] for w in lm.words_of(t)], 0] for t in texts]
    pairs = Counter((a, b) for s in sequences for a, b in zip(s, s[1:]))
    want = np.zeros((lm.CLASSES, lm.CLASSES), np.int64)
    for (a, b), n in pairs.items():
        want[model.class_of_unit[a], model.class_of_unit[b]] += n
    assert (lm.class_transitions(numbers, model.class_of_unit) == want).all()
    got = {r["code"]: r["n"] for r in lm.unit_neighbours(numbers, model.class_of_unit).collect()}
    cells = Counter()
    for (a, b), n in pairs.items():
        cells[a * lm.CELLS + model.class_of_unit[b]] += n
        cells[b * lm.CELLS + lm.CLASSES + model.class_of_unit[a]] += n
        cells[a * lm.CELLS + 2 * lm.CLASSES] += n * (a == b)
    assert got == {c: n for c, n in cells.items() if n}
    best = [lm.likelihood(lm.cluster(numbers, table.units, sweeps)[1]) for sweeps in (1, 2, 3)]
    assert best == sorted(best)


def test_encoding_once_gives_the_same_scores(documents):
    docs = documents([prose(i, 30) for i in range(12)] + [None, ""], keys=[*range(13), None])
    docs = docs.selectExpr("*", "1 as _key", "2 as _row", "3 as units")
    training = docs.doc_id % 3 < 2
    got = {r["doc_id"]: r for r in lm.fit_and_score(docs, training).collect()}
    want = {r["doc_id"]: r for r in lm.score(docs, *lm.fit(docs.filter(training))).collect()}
    assert got == want and len(got) == 14
