from __future__ import annotations

import random

import numpy as np

from forktide.llm import quality as q
from tests.llm.conftest import prose


def junk(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(w + r.choice(["!!", "$$$", "***"]) for w in prose(seed, words).split())


def test_chunks_cover_a_text():
    for n in (1, 64, 448, 511, 512, 513, 960, 5_000):
        chunks = q.chunks_of(n)
        assert chunks[0][0] == 0 and chunks[-1][1] == n
        assert all(b - a <= q.CHUNK for a, b in chunks)
        assert all(x[1] - y[0] == q.OVERLAP for x, y in zip(chunks, chunks[1:]))


def test_tables_give_the_answers_of_the_trainer(monkeypatch):
    trainer = q.Trainer(3)
    net = trainer.network(np.array([1.0, 0, 0, 0]))
    text = prose(4, 60).encode()[: q.CHUNK]
    data = np.zeros(len(text) + q.POOL * (2 + q.STEPS), np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    x = np.concatenate([trainer.p["e"][data], q.repeat_flags(data)[:, None]], 1)
    n = (len(data) - q.POOL) // q.POOL * q.POOL
    z = sum(x[o : o + n] @ trainer.p["w1"][o] for o in range(q.WIDTH)) + trainer.p["b1"]
    a = np.maximum(z.reshape(-1, q.POOL, q.FILTERS).max(1), 0)
    deep = [sum(a[i + o] @ trainer.p["w2"][o] for o in range(q.STEPS)) + trainer.p["b2"] for i in range(len(a) - q.STEPS)]
    got = q.chunk_logits([text], net)[0]
    last = max(1, -(-len(text) // q.POOL) - q.STEPS + 1)
    want = np.maximum(np.max(deep[:last], 0), 0) @ trainer.p["w3"] + trainer.p["b3"]
    assert abs(got[0] - want[0]) < 1e-3
    # Long texts in pieces, and texts beside others, score alike.
    long = prose(5, 3_000).encode()
    whole = q.chunk_logits([long], net)[0]
    monkeypatch.setattr(q, "SLICE_BYTES", 4 * q.CHUNK)
    assert np.allclose(q.chunk_logits([long], net)[0][1:-1], whole[1:-1], atol=1e-2)


def test_every_byte_reaches_the_answer():
    r = np.random.default_rng(0)
    net = q.Trainer(5).network(np.zeros(4))

    def wild():
        shapes = {f: np.shape(getattr(net, f)) for f in net.__dataclass_fields__}
        return type(net)(**{f: r.normal(size=s).astype(np.float32) if s else 0.0 for f, s in shapes.items()})

    nets = [wild() for _ in range(6)]
    for n in (1, 20, 79, 511, 512, 513, 960, 1_003):
        text = b"a" * n
        own = [q.chunk_logits([text], w)[0] for w in nets]
        # In an even text a changed byte shows as soon as it raises one filter of one network.
        silent = [
            i
            for i in range(max(0, n - 24), n)
            if all(
                (q.chunk_logits([text[:i] + bytes([c]) + text[i + 1 :]], w)[0] == o).all()
                for w, o in zip(nets, own)
                for c in (33, 65, 90, 200, 10, 48, 255, 122)
            )
        ]
        assert not silent, (n, silent)


def test_held_out_accuracy(documents, spark, monkeypatch):
    monkeypatch.setattr(q, "ROUNDS", 80)
    texts = [junk(i, 60) if i % 2 else prose(i, 60) for i in range(200)]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)] + [(None, 1), (5_000, 0)], "doc_id bigint, quality int")
    net = q.learn_from(labels, docs.select("doc_id", "text"))
    more = documents(texts + [None, ""], keys=list(range(202))).selectExpr("*", "'x' as score")
    p = {r["doc_id"]: r["score"] for r in q.score(more, net).collect()}
    assert sum((p[i] >= 0.5) == (i % 2 == 0) for i in range(120, 200)) >= 76
    assert p[200] == p[201] == 0
    assert q.score(docs.limit(0), net).count() == 0


def test_one_label_only(documents):
    assert q.learn([(1, b"a"), (1, b"b")]) is None
    assert {r["score"] for r in q.score(documents(["x", ""]), None).collect()} == {0.5, 0.0}
