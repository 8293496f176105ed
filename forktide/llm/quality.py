"""Quality of a text by a small convolutional network over its bytes.

Layers: four bytes wide filters over a learned embedding of each byte and one more channel that says
whether the last four bytes occurred within the 32 bytes before; the largest answer of every eight
positions; filters over eight such steps; the largest answer of each in a chunk of 512 bytes. Chunks
overlap by 64 bytes and cover the whole document. A chunk's answers give a logit, and the mean,
largest and smallest logit of a document's chunks give one probability.

The network is trained with numpy on a bounded sample of labelled whole texts (``PER_LABEL`` of each
label); scoring uses tables of the first layer by byte pairs, so a byte costs three lookups.

Defined results: NULL and empty texts score 0; equal texts score alike; without labelled rows, or
with one label only, every text scores 0.5 (empty ones 0); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forktide.llm.common import bounded_sample

PER_LABEL = 500
MAX_CHARS = 50_000
EMBEDDING, WIDTH, FILTERS = 6, 4, 12
POOL, STEPS, TOP = 8, 8, 10
CHUNK, OVERLAP = 512, 64
LAGS = range(2, 33)
ROUNDS, BATCH, RATE = 250, 64, 0.015
SLICE_BYTES = 1 << 19
# Zero bytes after a text, so that no filter sees two texts.
GAP = 2 * POOL * STEPS


@dataclass(frozen=True)
class Network:
    first: np.ndarray  # byte pair -> filters, bytes 0 and 1 of a window
    second: np.ndarray  # bytes 2 and 3
    repeats: np.ndarray  # four repeat flags -> filters, with the bias
    deep: np.ndarray
    deep_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    combine: np.ndarray  # mean, largest, smallest logit, bias


def repeat_flags(data: np.ndarray) -> np.ndarray:
    """Whether the four bytes that end at a position also ended at one of the LAGS before it."""
    padded = np.concatenate([np.zeros(3, np.uint8), data]).astype(np.uint32)
    grams = padded[:-3] | (padded[1:-2] << 8) | (padded[2:-1] << 16) | (padded[3:] << 24)
    found = np.zeros(len(data), bool)
    for lag in LAGS:
        found[lag:] |= grams[lag:] == grams[:-lag]
    return found & (grams != 0)


def chunks_of(length: int) -> list[tuple[int, int]]:
    """Chunks of a text of ``length`` bytes: every byte is in one, neighbours share OVERLAP bytes."""
    starts = range(0, max(1, length - OVERLAP), CHUNK - OVERLAP)
    return [(s, min(length, s + CHUNK)) for s in starts]


class Trainer:
    """The network while it learns: chunks of CHUNK bytes, padded with zeros."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.5, (256, EMBEDDING)),
            "w1": r.normal(0, 0.3, (WIDTH, EMBEDDING + 1, FILTERS)),
            "b1": np.zeros(FILTERS),
            "w2": r.normal(0, 0.1, (STEPS, FILTERS, TOP)),
            "b2": np.zeros(TOP),
            "w3": r.normal(0, 0.3, TOP),
            "b3": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.p["e"][0] = 0
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def step(self, data: np.ndarray, flags: np.ndarray, label: np.ndarray) -> None:
        p, n = self.p, len(data)
        x = np.concatenate([p["e"][data], flags[..., None].astype(np.float32)], -1)
        length = x.shape[1] - POOL  # windows start at every position that has room behind it
        cols = np.concatenate([x[:, o : o + length] for o in range(WIDTH)], -1)
        z1 = cols @ p["w1"].reshape(-1, FILTERS) + p["b1"]
        blocks = z1.reshape(n, length // POOL, POOL, FILTERS)
        at1 = blocks.argmax(2)
        a1 = np.maximum(np.take_along_axis(blocks, at1[:, :, None], 2)[:, :, 0], 0)
        steps = a1.shape[1] - STEPS + 1
        cols2 = np.concatenate([a1[:, o : o + steps] for o in range(STEPS)], -1)
        z2 = cols2 @ p["w2"].reshape(-1, TOP) + p["b2"]
        at2 = z2.argmax(1)
        a2 = np.maximum(np.take_along_axis(z2, at2[:, None], 1)[:, 0], 0)
        logit = a2 @ p["w3"] + p["b3"]
        g = ((1 / (1 + np.exp(-logit)) - label) / n).astype(np.float32)
        grad = {"w3": a2.T @ g, "b3": np.array([g.sum()])}
        ga2 = g[:, None] * p["w3"] * (a2 > 0)
        gz2 = np.zeros_like(z2)
        np.put_along_axis(gz2, at2[:, None], ga2[:, None], 1)
        grad["b2"] = ga2.sum(0)
        flat2 = gz2.reshape(-1, TOP)
        grad["w2"] = (cols2.reshape(-1, cols2.shape[-1]).T @ flat2).reshape(p["w2"].shape)
        back2 = (flat2 @ p["w2"].reshape(-1, TOP).T).reshape(n, steps, STEPS, FILTERS)
        ga1 = np.zeros_like(a1)
        for o in range(STEPS):
            ga1[:, o : o + steps] += back2[:, :, o]
        ga1 *= a1 > 0
        gz1 = np.zeros_like(blocks)
        np.put_along_axis(gz1, at1[:, :, None], ga1[:, :, None], 2)
        flat1 = gz1.reshape(-1, FILTERS)
        grad["b1"] = flat1.sum(0)
        grad["w1"] = (cols.reshape(-1, cols.shape[-1]).T @ flat1).reshape(p["w1"].shape)
        back1 = (flat1 @ p["w1"].reshape(-1, FILTERS).T).reshape(n, length, WIDTH, EMBEDDING + 1)
        ge = np.zeros_like(p["e"])
        for o in range(WIDTH):
            at, values = data[:, o : o + length].ravel(), back1[:, :, o, :EMBEDDING].reshape(-1, EMBEDDING)
            for d in range(EMBEDDING):
                ge[:, d] += np.bincount(at, weights=values[:, d], minlength=256)
        ge[0] = 0
        grad["e"] = ge
        self.t += 1
        for k, v in grad.items():
            v = v.astype(np.float32)
            self.m[k] = 0.9 * self.m[k] + 0.1 * v
            self.v[k] = 0.999 * self.v[k] + 0.001 * v * v
            step = self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            p[k] -= RATE * step

    def network(self, combine: np.ndarray) -> Network:
        p = self.p
        by_byte = np.einsum("be,oef->obf", p["e"], p["w1"][:, :EMBEDDING])
        low, high = np.arange(65536) & 255, np.arange(65536) >> 8
        bits = (np.arange(1 << WIDTH)[:, None] >> np.arange(WIDTH)) & 1
        f = np.float32
        return Network(
            (by_byte[0][low] + by_byte[1][high]).astype(f),
            (by_byte[2][low] + by_byte[3][high]).astype(f),
            (bits @ p["w1"][:, EMBEDDING] + p["b1"]).astype(f),
            p["w2"].reshape(-1, TOP).astype(f),
            p["b2"].astype(f),
            p["w3"].astype(f),
            float(p["b3"][0]),
            combine,
        )


def chunk_logits(texts: list[bytes], net: Network) -> list[np.ndarray]:
    """Logits of the chunks of each (not empty) text, texts taken in slices of bounded size."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for t in texts:
        if group and size + len(t) > SLICE_BYTES:
            out += _group_logits(group, net)
            group, size = [], 0
        if len(t) > SLICE_BYTES:
            out.append(_long_logits(t, net))
        else:
            group.append(t)
            size += len(t)
    return out + (_group_logits(group, net) if group else [])


def _long_logits(text: bytes, net: Network) -> np.ndarray:
    """Chunk by chunk groups of one very long text; a piece begins where a chunk begins."""
    many = SLICE_BYTES // CHUNK
    spans = chunks_of(len(text))
    parts = []
    for i in range(0, len(spans), many):
        own = spans[i : i + many]
        parts.append(_group_logits([text[own[0][0] : own[-1][1]]], net)[0][: len(own)])
    return np.concatenate(parts)


def _group_logits(texts: list[bytes], net: Network) -> list[np.ndarray]:
    padded, starts, at = [], [], 0
    for t in texts:
        room = -len(t) % POOL + GAP
        padded += [t, bytes(room)]
        starts.append(at)
        at += len(t) + room
    data = np.frombuffer(b"".join(padded), np.uint8)
    flags = repeat_flags(data).astype(np.uint8)
    wide = data.astype(np.uint16)
    pairs = wide[:-1] | (wide[1:] << 8)
    length = len(data) - POOL
    f4 = flags[:length] | (flags[1 : length + 1] << 1) | (flags[2 : length + 2] << 2) | (flags[3 : length + 3] << 3)
    z1 = net.first[pairs[:length]]
    z1 += net.second[pairs[2 : length + 2]]
    z1 += net.repeats[f4]
    a1 = np.maximum(z1.reshape(length // POOL, POOL, FILTERS).max(1), 0)
    view = np.lib.stride_tricks.sliding_window_view(a1, STEPS, axis=0).transpose(0, 2, 1)
    z2 = view.reshape(len(view), -1) @ net.deep + net.deep_bias
    cuts, sizes = [], []
    for t, start in zip(texts, starts):
        spans = chunks_of(len(t))
        sizes.append(len(spans))
        for a, b in spans:
            first = (start + a) // POOL
            # As many steps as in training: the last one ends with the chunk's last bytes.
            cuts += [first, first + max(1, -(-(b - a) // POOL) - STEPS + 1)]
    z2 = np.concatenate([z2, np.full((2 * STEPS, TOP), -np.inf, np.float32)])
    a2 = np.maximum(np.maximum.reduceat(z2, cuts, axis=0)[0::2], 0)
    logits = a2 @ net.out + net.out_bias
    return np.split(logits, np.cumsum(sizes)[:-1])


def _summary(logits: np.ndarray) -> list[float]:
    return [float(logits.mean()), float(logits.max()), float(logits.min()), 1.0]


def learn(sample: list[tuple[int, bytes]], seed: int = 7) -> Network | None:
    """The network of a list of (label 0 or 1, text); None unless both labels are there."""
    sample = [(y, t) for y, t in sample if t]
    if len({y for y, _ in sample}) < 2:
        return None
    r = np.random.default_rng(seed)
    trainer = Trainer(seed)
    by_label = [[t for y, t in sample if y == k] for k in (0, 1)]
    room = CHUNK + POOL
    for _ in range(ROUNDS):
        label = np.arange(BATCH) % 2
        data, flags = np.zeros((BATCH, room), np.uint8), np.zeros((BATCH, room), np.uint8)
        for i, y in enumerate(label):
            text = by_label[y][r.integers(len(by_label[y]))]
            spans = chunks_of(len(text))
            a, b = spans[r.integers(len(spans))]
            own = np.frombuffer(text[a:b], np.uint8)
            data[i, : len(own)] = own
            flags[i, : len(own)] = repeat_flags(own)
        trainer.step(data, flags, label)
    net = trainer.network(np.zeros(4))
    x = np.array([_summary(v) for v in chunk_logits([t for _, t in sample], net)])
    y = np.array([k for k, _ in sample], float)
    w = np.array([1.0, 0, 0, 0])
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(300):  # regularised logistic regression of the label on the summary
        g = x.T @ (weight * (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y)) / len(y) + 1e-3 * (w - [1, 0, 0, 0])
        w -= 0.05 * g
    return trainer.network(w)


def probabilities(texts: list[bytes], net: Network | None) -> np.ndarray:
    out = np.zeros(len(texts))
    full = [i for i, t in enumerate(texts) if t]
    if net is None:
        out[full] = 0.5
    elif full:
        x = np.array([_summary(v) for v in chunk_logits([texts[i] for i in full], net)])
        out[full] = 1 / (1 + np.exp(-np.clip(x @ net.combine, -30, 30)))
    return out


def learn_from(
    labels: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = PER_LABEL, max_chars: int = MAX_CHARS,
) -> Network | None:
    """Trained on a bounded sample of the labelled rows, whole texts."""
    sample = bounded_sample(labels, docs.select(key, text), key, label, per_label, max_chars)
    rows = [(int(r[0]), r[1].encode()) for r in sample.select(label, text).toLocalIterator()]
    rows.sort()
    return learn(rows)


def score(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(text).to_pylist()]
            p = probabilities(texts, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(p)], names=[key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text)).mapInArrow(run, f"`{key}` {kind}, score double")
