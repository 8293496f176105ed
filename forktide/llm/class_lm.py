"""Scoring texts with a class-based bigram model after Brown.

Words are runs of bytes other than ASCII white space, A-Z in lower case; every text ends with one
end token, which counts as a token. A word's probability after another is that of its class after the
other's class, times that of the word within its class. Classes are found by exchange clustering:
a word goes to the class that raises the likelihood of the training text most.

Counts are exact over all training texts: words are counted in each task and summed in a shuffle. The
most frequent words (at most ``MOST_FREQUENT``) are broadcast with their counts, and each is clustered
by its own neighbours; occurrences of other words are summed per text, shuffled by word and joined with
the counts. These rare words back off to ``SUFFIX_GROUPS`` groups by their last two bytes, which are
clustered like words. Words and groups together are called units; the border of texts is unit 0.

Texts are turned into numbers of units once and stored. The ``HEAD`` first units (border, groups and the
most frequent words) are exchanged one by one on the driver, from a table of at most ``HEAD ** 2`` cells.
Then sweeps over all units follow: the neighbours of every unit are counted by class in a shuffle, and
blocks of ``BLOCK`` units pick their best classes in parallel, each against the table of classes as it
was before the sweep. As moves made at the same time may hurt each other, an assignment is kept only
if the likelihood of the training text under it is the highest so far.

Smoothing: (c + 1) / (N_k + V_k + 1) for a word of count c in a class with N_k tokens of V_k words;
(n_kl + 0.5) / (n_k + 0.5 * classes) for a transition.

Defined results: NULL counts as the empty text, which holds the end token alone; equal texts have
equal scores; without training texts all counts are 0; rows without key count as training texts;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.llm.common import stored

SUFFIX_GROUPS = 255
FIRST_WORD = 1 + SUFFIX_GROUPS  # units: the border of texts, the groups of rare words, the frequent words
HEAD = 1024
CLASSES = 24
CELLS = 2 * CLASSES + 1  # of a unit: transitions to each class, from each class, and to itself
SWEEPS = 8  # of the exchange one by one
PARALLEL_SWEEPS = 3
BLOCK = 4096
MOST_FREQUENT = 250_000
FLUSH_WORDS = 400_000
FLUSH_ROWS = 50_000
UNASSIGNED = -1


@dataclass(frozen=True)
class WordTable:
    """Counts of the frequent words; word i is unit FIRST_WORD + i."""

    index: dict[bytes, int]
    log_count: np.ndarray  # log10(c + 1)

    @property
    def units(self) -> int:
        return FIRST_WORD + len(self.index)


@dataclass(frozen=True)
class ClassModel:
    class_of_unit: np.ndarray
    log_transition: np.ndarray
    log_class_size: np.ndarray  # log10(N_k + V_k + 1)
    tokens: int
    words: int
    ends: int


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def suffix_group(word: bytes) -> int:
    return 1 + zlib.crc32(word[-2:]) % SUFFIX_GROUPS


def _suffix_column(word: Column) -> Column:
    tail = F.when(F.length(word) > 2, F.substring(word, -2, 2)).otherwise(word)
    return (F.crc32(tail) % SUFFIX_GROUPS + 1).cast("int")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (binary) and ``c`` over all texts, ends not included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for i in range(0, len(words), FLUSH_ROWS):
                part = words[i : i + FLUSH_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.binary()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "c"]
                )
            counts.clear()

        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(words_of(value))
                if len(counts) >= FLUSH_WORDS:
                    yield from rows()
        yield from rows()

    return docs.select(text).mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequency_limit(counts: DataFrame, most: int = MOST_FREQUENT) -> int:
    """A count such that at most ``most`` words have it or more (counts within a 16th of an octave)."""
    step = F.floor(F.log2("c") * 16)
    sizes = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    limit, total = 1 << 62, 0
    for row in sorted(sizes, key=lambda r: -r["s"]):
        total += row["n"]
        if total > most:
            break
        limit = row["c"]
    return limit


def _units(words: list[bytes], table: WordTable) -> tuple[np.ndarray, list[bytes]]:
    """Units of the words, and the rare words among them."""
    get = table.index.get
    at = np.array([get(w, -1) for w in words], np.int32)
    units = at + np.int32(FIRST_WORD)
    rare = np.flatnonzero(at < 0)
    others = [words[i] for i in rare]
    units[rare] = [suffix_group(w) for w in others]
    return units, others


def encoded(docs: DataFrame, table: WordTable, text: str = "text") -> DataFrame:
    """``docs`` with its text replaced by ``units`` (32-bit numbers in bytes), ``rare`` words and their ``times``."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, rare, times = [], [], []
            for value in batch.column(text).to_pylist():
                of_text, words = _units(words_of(value), shared.value)
                own = Counter(words)
                units.append(of_text.tobytes())
                rare.append(list(own))
                times.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in others],
                    pa.array(units, pa.binary()),
                    pa.array(rare, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=[*others, "units", "rare", "times"],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others]
    return docs.mapInArrow(run, ", ".join([*kinds, "units binary", "rare array<binary>", "times array<bigint>"]))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units before and at every token; each text begins and ends at the border."""
    for batch in batches:
        row = np.concatenate([np.zeros(1, np.int32), *[
            np.append(np.frombuffer(v, np.int32), np.int32(0)) for v in batch.column(0).to_pylist()
        ]])
        for i in range(0, len(row) - 1, 1 << 20):
            part = row[i : i + (1 << 20) + 1]
            yield part[:-1], part[1:]


def _cells_of(seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Non-zero cells of a table of counts as rows ``code`` and ``n``."""
    for i in range(0, len(seen), 1 << 20):
        codes = np.flatnonzero(seen[i : i + (1 << 20)])
        for j in range(0, len(codes), FLUSH_ROWS):
            part = codes[j : j + FLUSH_ROWS] + i
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part].astype(np.int64))], names=["code", "n"])


def _summed(numbers: DataFrame, run) -> DataFrame:
    cells = numbers.select("units").mapInArrow(run, "code bigint, n bigint")
    return cells.groupBy("code").agg(F.sum("n").alias("n"))


def _table_of(cells: DataFrame, width: int) -> np.ndarray:
    """A small square table of counts on the driver."""
    found = cells.toPandas()
    n = np.zeros(width * width, np.int64)
    n[found["code"].to_numpy(np.int64)] = found["n"]
    return n.reshape(width, width)


def head_transitions(numbers: DataFrame, width: int = HEAD) -> np.ndarray:
    """Transitions between the first ``width`` units over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width * width, np.int64)
        for before, at in _neighbours(batches):
            both = (before < width) & (at < width)
            np.add.at(seen, before[both].astype(np.int64) * width + at[both], 1)
        yield from _cells_of(seen)

    return _table_of(_summed(numbers, run), width)


def class_transitions(numbers: DataFrame, own: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Transitions between the classes of all units over all texts."""
    shared = numbers.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, own = np.zeros(classes * classes, np.int64), shared.value
        for before, at in _neighbours(batches):
            code = own[before].astype(np.int64) * classes + own[at]
            seen += np.bincount(code[code >= 0], minlength=len(seen))
        yield from _cells_of(seen)

    return _table_of(_summed(numbers, run), classes)


def unit_neighbours(numbers: DataFrame, own: np.ndarray) -> DataFrame:
    """``code`` (unit * CELLS + cell) and ``n``: how often a unit stands before, after and beside which class."""
    shared = numbers.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        # One table per task, of at most (MOST_FREQUENT + FIRST_WORD) * CELLS numbers of four bytes.
        seen, one = np.zeros(len(own) * CELLS, np.int32), np.int32(1)
        for before, at in _neighbours(batches):
            of_before, of_at = own[before], own[at]
            code = before.astype(np.int64) * CELLS + of_at
            np.add.at(seen, code[of_at >= 0], one)
            code = at.astype(np.int64) * CELLS + (CLASSES + of_before)
            np.add.at(seen, code[of_before >= 0], one)
            same = at[before == at].astype(np.int64)
            np.add.at(seen, same * CELLS + 2 * CLASSES, one)
        yield from _cells_of(seen)

    return _summed(numbers, run)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log likelihood of the training text, from their transitions."""
    table = table.astype(np.float64)
    return float(_f(table).sum() - _f(table.sum(0)).sum() - _f(table.sum(1)).sum())


def best_classes(out: np.ndarray, into: np.ndarray, self_: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The best class of each unit, alone, in a ``table`` of transitions of classes.

    ``out`` and ``into`` are the unit's transitions to and from each class, ``self_`` those to itself;
    those of a unit with a class are part of the table, those of an unassigned one are not.
    """
    r, c = out.astype(np.float64), into.astype(np.float64)
    n, classes = r.shape
    with_class = np.flatnonzero(own >= 0)
    k, s = own[with_class], self_[with_class].astype(np.float64)
    r[with_class, k] -= s
    c[with_class, k] -= s
    without = np.repeat(table.astype(np.float64)[None], n, 0)
    without[with_class, k, :] -= r[with_class]
    without[with_class, :, k] -= c[with_class]
    without[with_class, k, k] -= s
    gain = (_f(without + r[:, None, :]) - _f(without)).sum(2) + (_f(without + c[:, :, None]) - _f(without)).sum(1)
    diagonal = np.arange(classes)
    d, own_loops = without[:, diagonal, diagonal], self_.astype(np.float64)[:, None]
    gain += _f(d + r + c + own_loops) - _f(d + r) - _f(d + c) + _f(d)
    rows, cols = without.sum(2) + c, without.sum(1) + r
    gain -= _f(rows + r.sum(1, keepdims=True) + own_loops) - _f(rows)
    gain -= _f(cols + c.sum(1, keepdims=True) + own_loops) - _f(cols)
    gain[:, 0] = -np.inf
    best = gain.argmax(1)
    stays = np.zeros(n, bool)
    stays[with_class] = gain[with_class, best[with_class]] <= gain[with_class, k] + 1e-9
    return np.where(stays, own, best)


def moved(cells: DataFrame, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """New classes of all units; blocks of units are worked on in parallel."""
    shared = cells.sparkSession.sparkContext.broadcast((own, table))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own, table = shared.value
        code, n = rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        first = int(code[0]) // (CELLS * BLOCK) * BLOCK
        counts = np.bincount(code - first * CELLS, weights=n, minlength=BLOCK * CELLS).reshape(BLOCK, CELLS)
        units = np.unique(code // CELLS)
        units = units[units > 0]  # the border keeps its class
        found = [
            best_classes(
                counts[part - first, :CLASSES], counts[part - first, CLASSES : 2 * CLASSES],
                counts[part - first, 2 * CLASSES], own[part], table,
            )
            for part in np.array_split(units, len(units) // 256 + 1)
        ]
        return pd.DataFrame({"unit": units, "k": np.concatenate(found).astype(np.int64)})

    block = F.floor(F.col("code") / (CELLS * BLOCK)).alias("block")
    new = cells.groupBy(block).applyInPandas(run, "unit bigint, k bigint").toPandas()
    result = own.copy()
    result[new["unit"].to_numpy(np.int64)] = new["k"].to_numpy(np.int64)
    return result


def cluster(numbers: DataFrame, units: int, sweeps: int = PARALLEL_SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units, and the transitions between the classes."""
    own = np.full(units, UNASSIGNED, np.int16)
    width = min(HEAD, units)
    own[:width] = exchange(head_transitions(numbers, width))
    best, table = None, class_transitions(numbers, own)
    for sweep in range(sweeps):
        own = moved(unit_neighbours(numbers, own), own, table)
        own[own == UNASSIGNED] = 1  # units that do not occur
        table = class_transitions(numbers, own)
        if best is not None and likelihood(table) <= likelihood(best[1]):
            break
        best = own, table
    return best


def exchange(n: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the units with transition counts ``n``; unit 0 keeps class 0 to itself."""
    n = n.astype(np.float64)
    weight = n.sum(1)
    order = [int(u) for u in np.argsort(-weight, kind="stable") if u != 0]
    own = np.zeros(len(n), np.int64)
    own[order] = 1 + np.arange(len(order)) % (classes - 1)

    f = _f
    member = np.eye(classes)[own]
    out, into = n @ member, n.T @ member  # per unit: transitions to and from each class
    table = member.T @ out
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moves = 0
        for u in order:
            if weight[u] == 0:
                continue
            k = own[u]
            self_ = n[u, u]
            r, c = out[u].copy(), into[u].copy()
            r[k] -= self_
            c[k] -= self_
            table[k] -= r
            table[:, k] -= c
            table[k, k] -= self_
            rows, cols = table.sum(1), table.sum(0)
            gain = (f(table + r) - f(table)).sum(1) + (f(table + c[:, None]) - f(table)).sum(0)
            d = table[diagonal, diagonal]
            gain += f(d + r + c + self_) - f(d + r) - f(d + c) + f(d)
            # Whatever the class of u, its neighbours' classes get its transitions on their other side.
            rows, cols = rows + c, cols + r
            gain -= f(rows + r.sum() + self_) - f(rows) + f(cols + c.sum() + self_) - f(cols)
            gain[0] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[k] + 1e-9:
                best = k
            table[best] += r
            table[:, best] += c
            table[best, best] += self_
            if best != k:
                moves += 1
                own[u] = best
                out[:, k] -= n[:, u]
                out[:, best] += n[:, u]
                into[:, k] -= n[u]
                into[:, best] += n[u]
        if moves < len(order) // 200 + 1:
            break
    return own


def frequent_words(training: DataFrame, text: str = "text") -> tuple[DataFrame, int, WordTable]:
    """Word counts (a stored table), the limit of frequent words, and their table."""
    counts = stored(training.sparkSession, word_counts(training, text), "words")
    limit = frequency_limit(counts)
    top = counts.filter(F.col("c") >= limit).toPandas()
    top = top.assign(word=[bytes(w) for w in top["word"]]).sort_values(["c", "word"], ascending=[False, True])
    table = WordTable({w: i for i, w in enumerate(top["word"])}, np.log10(top["c"].to_numpy(np.int64) + 1.0))
    return counts, limit, table


def learn(numbers: DataFrame, counts: DataFrame, limit: int, table: WordTable) -> ClassModel:
    """The model of texts given as units."""
    own, between = cluster(numbers, table.units)
    # Words per unit: a frequent word is one, the others are counted by group.
    words = np.ones(table.units, np.int64)
    words[:FIRST_WORD] = 0
    rest = counts.filter(F.col("c") < limit).groupBy(_suffix_column(F.col("word")).alias("u"))
    for row in rest.agg(F.count(F.lit(1)).alias("v")).collect():
        words[row["u"]] += row["v"]
    ends = int(between[:, 0].sum())
    words[0] = int(ends > 0)
    transition = (between + 0.5) / (between.sum(1, keepdims=True) + 0.5 * CLASSES)
    sizes = between.sum(0) + np.bincount(own, weights=words, minlength=CLASSES) + 1
    return ClassModel(own, np.log10(transition), np.log10(sizes), int(between.sum()), int(words.sum()), ends)


def fit(training: DataFrame, text: str = "text") -> tuple[DataFrame, int, WordTable, ClassModel]:
    """Word counts (a stored table), the limit of frequent words, their table, and the model."""
    counts, limit, table = frequent_words(training, text)
    numbers = stored(training.sparkSession, encoded(training.select(text), table, text).select("units"), "units")
    return counts, limit, table, learn(numbers, counts, limit, table)


def score(
    docs: DataFrame, counts: DataFrame, limit: int, table: WordTable, model: ClassModel,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``."""
    parts = stored(docs.sparkSession, encoded(_numbered(docs, key, text), table, "_text"), "parts")
    return _scored(parts, counts, limit, table, model).withColumnRenamed("_key", key)


def fit_and_score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` of all rows by a model of those for which ``training`` holds; each text is encoded once."""
    rows = _numbered(docs, key, text, F.coalesce(training, F.lit(False)).alias("_training"))
    counts, limit, table = frequent_words(rows.filter("_training"), "_text")
    parts = stored(docs.sparkSession, encoded(rows, table, "_text"), "parts")
    model = learn(parts.filter("_training").select("units"), counts, limit, table)
    return _scored(parts, counts, limit, table, model).withColumnRenamed("_key", key)


def _numbered(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    row = F.monotonically_increasing_id().alias("_row")
    return docs.select(F.col(key).alias("_key"), row, F.col(text).alias("_text"), *more)


def _scored(parts: DataFrame, counts: DataFrame, limit: int, table: WordTable, model: ClassModel) -> DataFrame:
    log_of_unit = np.concatenate([[np.log10(model.ends + 1.0)], np.zeros(FIRST_WORD - 1), table.log_count])
    shared = parts.sparkSession.sparkContext.broadcast((log_of_unit, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_of_unit, m = shared.value
        for batch in batches:
            n_tokens, known, logs, classes = [], [], [], []
            for value in batch.column("units").to_pylist():
                units = np.append(np.frombuffer(value, np.int32), np.int32(0))
                k = m.class_of_unit[units]
                before = np.append(np.int16(0), k[:-1])
                n_tokens.append(len(k))
                known.append(int((units >= FIRST_WORD).sum()) + int(m.ends > 0))
                logs.append(float(log_of_unit[units].sum()))
                classes.append(float(m.log_transition[before, k].sum() - m.log_class_size[k].sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    batch.column("_row"),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(logs, pa.float64()),
                    pa.array(classes, pa.float64()),
                ],
                names=["_key", "_row", "n_tokens", "known", "logs", "classes"],
            )

    kind = parts.schema["_key"].dataType.simpleString()
    texts = parts.select("_key", "_row", "units").mapInArrow(
        run, f"_key {kind}, _row bigint, n_tokens bigint, known bigint, logs double, classes double"
    )
    each = parts.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    each = each.select("_row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    found = (
        each.join(counts.filter(F.col("c") < limit), "word")
        .groupBy("_row")
        .agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_logs"), F.sum("times").alias("more_known"))
    )
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    total = float(np.log10(model.tokens + model.words + 1.0))
    return texts.join(found, "_row", "left").select(
        "_key",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (logs + F.col("classes")).alias("score"),
        F.pow(F.lit(10.0), -(logs + F.col("classes")) / F.col("n_tokens")).alias("perplexity"),
    )
