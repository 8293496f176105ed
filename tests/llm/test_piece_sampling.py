from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from forktide.llm import piece_sampling as ps
from tests.llm.conftest import prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def v():
    return ps.Vocabulary(PATH)


def enumerate_all(text, v):
    """Log probability of every segmentation."""
    t = ps.BLANK + text.replace(" ", ps.BLANK)
    piece = {b.decode(): i for i, b in enumerate(v.bytes_of) if b and v.weight[i] < 0}
    out = []

    def go(i, ids, w):
        if i == len(t):
            out.append((tuple(ids), w))
            return
        for n in range(1, v.longest + 1):
            if i + n <= len(t) and t[i : i + n] in piece:
                go(i + n, [*ids, piece[t[i : i + n]]], w + v.weight[piece[t[i : i + n]]])
        if t[i] not in piece:
            data = t[i].encode()
            go(i + 1, ids + [int(v.byte_id[b]) for b in data], w + v.byte_weight * len(data))

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in out])
    return {ids: w - total for ids, w in out}


def test_samples_follow_the_distribution_without_replacement(v):
    text, n = "the ab\n", 4_000
    all_ = enumerate_all(text, v)
    p = {i: np.exp(w) for i, w in all_.items()}
    seeds = np.random.default_rng(3).integers(0, 2**63, n).astype(np.uint64)
    drawn: dict[int, list] = {}
    estimate = Counter()
    for t, rank, ids, log_p, score, inclusion in ps.sample([text] * n, seeds, v, 2):
        ids = tuple(map(int, ids))
        assert abs(all_[ids] - log_p) < 1e-6
        drawn.setdefault(t, []).append((ids, score))
        estimate[ids] += np.exp(log_p) / inclusion / n
    assert all(len(x) == len({i for i, _ in x}) == 2 and x[0][1] >= x[1][1] for x in drawn.values())
    first, second = (Counter(x[k][0] for x in drawn.values()) for k in (0, 1))
    for i in sorted(p, key=p.get)[-3:]:
        assert abs(first[i] / n - p[i]) < 0.03
        assert abs(second[i] / n - sum(p[j] * p[i] / (1 - p[j]) for j in p if j != i)) < 0.03
        assert abs(estimate[i] - p[i]) < 0.03


def test_few_segmentations_are_all_returned(v):
    got = list(ps.sample(["é"], np.array([5], np.uint64), v, 50))
    all_ = enumerate_all("é", v)
    assert {tuple(map(int, g[2])) for g in got} == set(all_)
    assert all(g[5] == 1.0 for g in got)


def test_round_trip_and_library_decoding(v):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["a  b", "Hello\tworld\n\nx", prose(1, 80), "中文😀 é", " lead", "trail ", "x" * 3_000]
    for t, _, ids, *_ in ps.sample(texts, np.arange(len(texts)).astype(np.uint64), v, 3):
        assert ps.decode(ids, v) == texts[t] == model.decode(ids.tolist())


def test_rows_do_not_depend_on_their_neighbours(documents, monkeypatch):
    texts = [prose(i, 20) for i in range(12)] + [None, "", "a"]
    docs = documents(texts, keys=[*range(13), None, 14]).selectExpr("*", "1 as sample")

    def rows(df):
        return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["sample"], tuple(r["ids"]), round(r["inclusion"], 9)) for r in df.collect())

    one = rows(ps.segmentations(docs, PATH))
    assert one == rows(ps.segmentations(docs.repartition(4), PATH))
    monkeypatch.setattr(ps, "GROUP_CHARS", 100)
    assert len({r[0] for r in one}) == 15
    assert ps.segmentations(docs.limit(0), PATH).count() == 0
    assert ps.segmentations(docs, PATH, with_ids=False).filter("not round_trip").count() == 0


def test_long_words_and_small_parts_give_the_same_samples(v, monkeypatch):
    texts = [prose(1, 60), "x" * 400 + " é" + "ab" * 300, "", "中文😀" * 50, prose(2, 30)]
    texts = [t for t in texts if t]
    seeds = np.arange(len(texts)).astype(np.uint64)

    def drawn(lattice=None):
        return [(t, rank, tuple(map(int, ids)), round(score, 5)) for t, rank, ids, _, score, _ in ps.sample(texts, seeds, v, 3, lattice)]

    wanted = drawn()
    for name, value in (("LONG", v.longest), ("PART", 7), ("FEW", 10**6), ("ADDED", 20), ("KEPT_NODES", 50)):
        monkeypatch.setattr(ps, name, value)
        assert drawn() == wanted, name
    kept = ps.Lattice(v)
    assert drawn(kept) == drawn(kept) == wanted


def test_a_very_long_word(v):
    text = "".join("abcdefgh"[i * i % 61 % 8] for i in range(200_000))
    found = list(ps.sample([text], np.array([3], np.uint64), v, 2))
    assert len(found) == 2 and all(ps.decode(f[2], v) == text for f in found)


def test_sets_that_were_put_off_are_found_later(v, monkeypatch):
    all_ = enumerate_all("the ab", v)
    monkeypatch.setattr(ps, "HIGHEST", 1.0)
    for seed in range(5):
        got = list(ps.sample(["the ab"], np.array([seed], np.uint64), v, len(all_) + 1))
        assert {tuple(map(int, g[2])) for g in got} == set(all_) and len(got) == len(all_)


def test_third_samples_follow_the_distribution(v):
    n = 3_000
    p = {i: np.exp(w) for i, w in enumerate_all("the a", v).items()}
    seeds = np.random.default_rng(4).integers(0, 2**63, n).astype(np.uint64)
    drawn = [{} for _ in range(n)]
    for t, rank, ids, *_ in ps.sample(["the a"] * n, seeds, v):
        drawn[t][rank] = tuple(map(int, ids))
    assert all(len(set(d.values())) == min(ps.SAMPLES, len(p)) > 2 for d in drawn)
    third = Counter(d[3] for d in drawn)
    for i in sorted(p, key=p.get)[-3:]:
        pairs = [(a, b) for a in p for b in p if len({a, b, i}) == 3]
        wanted = sum(p[a] * p[b] / (1 - p[a]) * p[i] / (1 - p[a] - p[b]) for a, b in pairs)
        assert abs(third[i] / n - wanted) < 0.035


def test_words_that_share_a_hash(v):
    word = "".join("ab"[i.bit_count() & 1] for i in range(4_096))
    texts = [word, word.translate({97: 98, 98: 97}), word]
    for t, _, ids, *_ in ps.sample(texts, np.arange(3).astype(np.uint64), v, 1, ps.Lattice(v)):
        assert ps.decode(ids, v) == texts[t]


def test_the_operator_opens_several_sets(documents):
    rows = ps.segmentations(documents([prose(1, 40)]), PATH, with_ids=False).collect()
    assert sorted(r["sample"] for r in rows) == [1, 2, 3, 4] and len({r["ids_sha256"] for r in rows}) == 4


def test_words_that_come_up_again_are_kept(v, monkeypatch):
    texts = [prose(i, 40) for i in range(6)]
    seeds = np.arange(len(texts)).astype(np.uint64)
    wanted = [(tuple(map(int, ids)), score) for _, _, ids, _, score, _ in ps.sample(texts, seeds, v)]
    lattice, added = ps.Lattice(v), []
    add = lattice.add
    monkeypatch.setattr(lattice, "add", lambda points, lengths: (added.append(len(lengths)), add(points, lengths)))
    monkeypatch.setattr(ps, "KEPT_NODES", 10_000)
    assert len(list(ps.sample(texts, seeds, v, lattice=lattice))) == len(list(ps.sample(texts, seeds, v, lattice=lattice)))
    monkeypatch.setattr(ps, "KEPT_NODES", 2 * lattice.nodes)
    lattice.forget()
    before = len(added)
    got = [(tuple(map(int, ids)), score) for _, _, ids, _, score, _ in ps.sample(texts, seeds, v, lattice=lattice)]
    assert got == wanted and added[before:] in ([], [0])
    monkeypatch.setattr(ps, "KEPT_NODES", 40)
    lattice.forget()
    assert 0 < lattice.nodes <= 20 and lattice.added == len(lattice.hashes)
    assert [x[2].tolist() for x in ps.sample(texts, seeds, v, lattice=lattice)] == [list(i) for i, _ in wanted]


def test_put_off_sets_bound_their_draws(v):
    """Sets without a bound yet can only be drawn below what is noted for them."""
    texts = [prose(i, 200) for i in range(8)]
    seeds = np.arange(len(texts)).astype(np.uint64)
    group = ps._Group([ps.BLANK + t.replace(" ", ps.BLANK) for t in texts], seeds, ps.Lattice(v))
    edge = np.full(int(group.ends[-1]), -1, np.int32)
    group.walk(0, group.word_start.copy(), np.arange(len(group.word_start)), edge)
    group.add_path(edge, np.zeros(len(texts)), group.starts, 2)
    most, top = group.put_off[0].copy(), group.best()[0]
    assert np.isfinite(most).all() and (most <= top).all()
    old = group.bound[0].copy()
    for t in range(len(texts)):
        group._settle(0, t)
        a, b = group.part[0][t : t + 2]
        late = np.isneginf(old[a:b])
        assert np.isfinite(group.bound[0][a:b][late]).any() and group.bound[0][a:b][late].max() <= most[t]
    assert (group.best()[0] == top).all()


def test_kept_lattices_are_small(v):
    """Twelve groups of 100,000 characters of words that never come up again."""
    letters = np.random.default_rng(3).integers(ord("a"), ord("z") + 1, (12, 100_000)).astype(np.uint8)
    letters[:, ::8] = ord(" ")
    lattice = ps.Lattice(v)
    for seed, text in enumerate(letters):
        (row,) = ps.sample([text.tobytes().decode()], np.array([seed], np.uint64), v, 1, lattice)
        assert ps.decode(row[2], v).encode() == text.tobytes()
    assert sum(x.nbytes for x in vars(lattice).values() if isinstance(x, np.ndarray)) < 60_000_000
