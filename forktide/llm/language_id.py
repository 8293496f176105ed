"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to three bytes, learned from a bounded sample of
labelled documents and then frozen. The code length of a byte is that of PPM method C: in a context
that was seen n times with d different bytes, a byte seen k times costs ``-log2(k / (n + d))``, any
other byte costs an escape, ``-log2(d / (n + d))``, and is then coded in the context one byte
shorter, at the end among all 256 bytes alike. A text belongs to the language whose tree codes it
shortest. Code lengths are those of the text's own UTF-8 bytes, none folded or merged; before a text
stand three blanks.

The trees of all languages are laid out together and sparsely: for every order the strings of context
and byte that some language has seen, sorted, with a code length per language, and the contexts with
what an escape costs. A byte is looked up in the longest order that has it; only where no language has
seen it there, the escapes are added and the next shorter order is asked. The layout has at most four
strings for each byte of the sample, whatever the script.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; ties go to the
language that sorts first; repeated rows get equal results; an empty training set makes every text
``und``; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forktide.llm.common import bounded_sample, give_back

BYTES = 256
ORDER = 3
UNKNOWN = "und"
# Bounds of the training sample: documents per language, and characters of one of them.
DOCUMENTS_PER_LANGUAGE = 600
MAX_CHARS = 50_000
# Beyond this many bytes, evidence counts as if the text had this many: the score stays below 1.
EVIDENCE_BYTES = 24
SLICE_BYTES = 1 << 19
GROUP_TEXTS = 500
# A text is accepted from this score on; with EVIDENCE_BYTES even short plain sentences reach it.
LEAST_SCORE = 0.3


@dataclass(frozen=True)
class ContextTrees:
    """Per order: ``grams`` (context and byte as one number, sorted) with ``bits``, ``contexts`` with ``escapes``.

    ``bits`` and ``escapes`` have a row per gram or context and a column per language.
    """

    languages: tuple[str, ...]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]


def _bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after ORDER blanks; the first position and the length of each."""
    lengths = np.array([len(t) for t in texts], np.int64)
    pad = b" " * ORDER
    s = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]]) + ORDER
    return s, starts, lengths


def _grams(s: np.ndarray, order: int) -> np.ndarray:
    """At every byte after the first ORDER ones: the byte with the ``order`` bytes before it."""
    out = np.zeros(len(s) - ORDER, np.uint32)
    for o in range(order, -1, -1):
        out = (out << np.uint32(8)) | s[ORDER - o : len(s) - o]
    return out


def _find(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted numbers among the sorted known ones, -1 for those that are not there."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def learn(sample: list[tuple[str, bytes]]) -> ContextTrees:
    """Trees of the languages in ``sample`` of (language, text)."""
    languages = tuple(sorted({lang for lang, _ in sample}))
    seen = []  # per language and order: grams and how often
    for lang in languages:
        s, starts, _ = _bytes([t for known, t in sample if known == lang])
        inside = np.ones(len(s), bool)
        for o in range(1, ORDER + 1):
            inside[starts - o] = False
        seen.append([np.unique(_grams(s, o)[inside[ORDER:]], return_counts=True) for o in range(ORDER + 1)])
    trees = ContextTrees(languages, [], [], [], [])
    for o in range(ORDER + 1):
        grams = np.unique(np.concatenate([of_lang[o][0] for of_lang in seen]))
        contexts, context = np.unique(grams >> np.uint32(8), return_inverse=True)
        bits = np.empty((len(grams), len(languages)), np.float32)
        escapes = np.empty((len(contexts), len(languages)), np.float32)
        for k, of_lang in enumerate(seen):
            counts = np.zeros(len(grams), np.int64)
            counts[np.searchsorted(grams, of_lang[o][0])] = of_lang[o][1]
            n = np.bincount(context, weights=counts, minlength=len(contexts))
            d = np.bincount(context, weights=counts > 0, minlength=len(contexts))
            with np.errstate(divide="ignore", invalid="ignore"):
                # A context that this language has not seen costs nothing to leave.
                escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
                found = -np.log2(counts / (n + d)[context])
            shorter = np.log2(BYTES)
            if o:
                # Every gram ends with one that is a byte shorter, which some language has seen, too.
                tail = grams & np.uint32((1 << (8 * o)) - 1)
                shorter = trees.bits[o - 1][np.searchsorted(trees.grams[o - 1], tail), k]
            bits[:, k] = np.where(counts > 0, found, escape[context] + shorter)
            escapes[:, k] = escape
        trees.grams.append(grams)
        trees.bits.append(bits)
        trees.contexts.append(contexts)
        trees.escapes.append(escapes)
    return trees


def _costs(s: np.ndarray, trees: ContextTrees) -> np.ndarray:
    """Bits of every byte after the first ORDER ones under each language."""
    grams = _grams(s, ORDER)
    row = _find(trees.grams[ORDER], grams)
    out = np.zeros((len(grams), len(trees.languages)), np.float32)
    out[row >= 0] = trees.bits[ORDER][row[row >= 0]]
    left = np.flatnonzero(row < 0)
    for o in range(ORDER, -1, -1):
        if not len(left):
            break
        if o < ORDER:
            row = _find(trees.grams[o], grams[left] & np.uint32((1 << (8 * (o + 1))) - 1))
            there = row >= 0
            out[left[there]] += trees.bits[o][row[there]]
            left = left[~there]
        context = (grams[left] >> np.uint32(8)) & np.uint32((1 << (8 * o)) - 1)
        row = _find(trees.contexts[o], context)
        out[left[row >= 0]] += trees.escapes[o][row[row >= 0]]
    out[left] += np.float32(np.log2(BYTES))
    return out


def code_lengths(texts: list[bytes], trees: ContextTrees) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(texts), len(trees.languages)))
    if not texts:
        return out
    s, starts, lengths = _bytes(texts)
    # Long texts are summed slice by slice; each position needs only the three bytes before it.
    owner_start = 0
    for begin in range(ORDER, len(s), SLICE_BYTES):
        end = min(len(s), begin + SLICE_BYTES)
        # Pieces of texts within this slice, without the blanks between them.
        while owner_start < len(texts) and starts[owner_start] + lengths[owner_start] <= begin:
            owner_start += 1
        last = owner_start
        while last < len(texts) and starts[last] < end:
            last += 1
        ids = np.arange(owner_start, last)
        low = np.maximum(starts[ids], begin) - begin
        high = np.minimum(starts[ids] + lengths[ids], end) - begin
        ids, low, high = ids[high > low], low[high > low], high[high > low]
        if len(ids) == 0:
            continue
        values = _costs(s[begin - ORDER : end], trees)
        cuts = np.empty(2 * len(ids), np.int64)
        cuts[0::2], cuts[1::2] = low, high
        values = np.concatenate([values, np.zeros((1, values.shape[1]), np.float32)])
        out[ids] += np.add.reduceat(values, cuts, axis=0, dtype=np.float64)[0::2]
    return out


def confidence(bits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Posterior of the shortest code, with evidence limited to that of EVIDENCE_BYTES bytes."""
    scale = np.minimum(1.0, EVIDENCE_BYTES / np.maximum(lengths, 1))
    gap = (bits - bits.min(1, keepdims=True)) * scale[:, None]
    return 1.0 / np.exp2(-gap).sum(1)


def learn_from(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = DOCUMENTS_PER_LANGUAGE, max_chars: int = MAX_CHARS,
) -> ContextTrees | None:
    """Trees from a bounded sample of whole labelled texts; None if there are none."""
    sample = bounded_sample(labelled, labelled.select(key, text), key, lang, per_language, max_chars)
    rows = [(r[0], r[1].encode()) for r in sample.select(lang, text).toLocalIterator()]
    rows.sort()
    return learn(rows) if rows else None


def _predicted(texts: list[str | None], trees: ContextTrees) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language (one past the last: unknown) and score of each text; a few texts at a time."""
    parts = [_predicted_few(texts[i : i + GROUP_TEXTS], trees) for i in range(0, max(1, len(texts)), GROUP_TEXTS)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _predicted_few(texts: list[str | None], trees: ContextTrees) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() if t else b"" for t in texts]
    bits = code_lengths(data, trees)
    lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
    best = np.where(lettered, bits.argmin(1), len(trees.languages))
    return best, np.where(lettered, confidence(bits, np.array([len(d) for d in data])), 0.0)


def accepted(docs: DataFrame, trees: ContextTrees | None, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is known with at least score ``least``."""
    if trees is None:
        return docs.filter(F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = _predicted(batch.column(text).to_pylist(), shared.value)
            yield batch.filter(pa.array((best < len(shared.value.languages)) & (score >= least)))
            give_back()

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, trees: ContextTrees | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (existing ones are replaced)."""
    docs = docs.drop("lang_pred", "score")
    if trees is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            best, score = _predicted(batch.column(text).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, names.take(pa.array(best)), pa.array(score)],
                names=[*batch.schema.names, "lang_pred", "score"],
            )
            give_back()

    schema = T.StructType(
        [*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)
