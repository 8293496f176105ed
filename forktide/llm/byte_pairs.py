"""Byte-level byte-pair encoding and decoding over padded matrices.

Texts are cut into words by the vocabulary's pattern, and each word is encoded once for as long as it is
kept. Words that are not known yet are gathered over a group of texts, put into buckets by length and
written as rows of padded matrices of ids, one column per byte. In a round every row merges its
leftmost pair of minimum rank: ranks come from an open hash table of pairs, the columns behind the
merge move up, only the two pairs beside it are looked up anew, and rows without a pair to merge leave
the matrix. A word that is a vocabulary entry as a whole is that entry.

No merge crosses two bytes that no entry of the vocabulary spans, so long words are cut there. What is
still longer than the longest bucket is merged by a queue of pairs, in the same order and in time
n log n, as a row that loses one id a round would take n^2.

NULL and empty texts have no ids and decode to no bytes. Texts of any length are encoded whole, in parts of
bounded size. Special strings in a text are ordinary text. Repeated rows give repeated results. Only
the key and text columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forktide.llm.common import give_back, texts_of
from forktide.llm.token_counts import WORDS

NONE = np.int32(2**31 - 1)
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)  # bytes of the longest word of a bucket
CELLS = 1 << 20  # of one matrix
GROUP = 1 << 19  # code points of the texts whose new words are encoded together
PART_WORDS = 1 << 16  # words of a text that are taken at a time
KEPT_WORDS = 300_000  # in each of two generations
LONGEST_KEPT = 64  # code points
KNUTH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open hash table from a pair of ids to the rank of what they merge to."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(2 * len(ranks)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        keys = (lefts.astype(np.int64) << 32) | rights.astype(np.int64)
        slots, todo = self.slots(keys), np.arange(len(keys))
        while len(todo):
            # Of the keys that want a free slot one gets it; the others go on to the next.
            free = todo[self.keys[slots[todo]] == -1]
            self.keys[slots[free]] = keys[free]
            done = self.keys[slots[todo]] == keys[todo]
            self.ranks[slots[todo[done]]] = ranks[todo[done]]
            todo = todo[~done]
            slots[todo] = (slots[todo] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * KNUTH) >> self.shift).astype(np.int64)

    def find(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NONE where they do not merge; ids below 0 are padding."""
        keys = (lefts.astype(np.int64) << 32) | (rights.astype(np.int64) & 0xFFFFFFFF)
        slots = self.slots(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.ranks[slots], NONE)
        todo = np.flatnonzero((seen != keys) & (seen != -1))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & self.mask
            seen = self.keys[slots[todo]]
            out[todo] = np.where(seen == keys[todo], self.ranks[slots[todo]], NONE)
            todo = todo[(seen != keys[todo]) & (seen != -1)]
        return out


class BytePairs:
    """Encodes and decodes under the rank file at ``path`` (base64 of an entry and its rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            entries = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(e): int(r) for e, r in entries}
        self.entry = [b""] * (max(self.rank.values()) + 1)
        for e, r in self.rank.items():
            self.entry[r] = e
        pairs = [
            (self.rank[e[:i]], self.rank[e[i:]], r)
            for e, r in self.rank.items()
            for i in range(1, len(e))
            if e[:i] in self.rank and e[i:] in self.rank
        ]
        lefts, rights, ranks = (np.array(x, np.int32) for x in zip(*pairs)) if pairs else [np.zeros(0, np.int32)] * 3
        self.pairs = PairTable(lefts, rights, ranks)
        self.merge = {(a, b): r for a, b, r in pairs}
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.spanned = np.zeros((256, 256), bool)
        for e in self.rank:
            if len(e) > 1:
                data = np.frombuffer(e, np.uint8)
                self.spanned[data[:-1], data[1:]] = True
        self._kept: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    # ---- words -----------------------------------------------------------------------------------

    def _rounds(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes, as little-endian 32-bit integers."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((n, width), -1, np.int32)
        ids[inside] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((n, width), NONE, np.int32)
        ranks[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        out: list[bytes] = [b""] * n
        rows = np.arange(n)
        while True:
            at = ranks.argmin(axis=1)  # the leftmost of the lowest
            own = np.arange(len(rows))
            best = ranks[own, at]
            live = best != NONE
            if not live.all():
                ended = np.flatnonzero(~live)
                for row, length, done in zip(rows[ended].tolist(), lengths[ended].tolist(), ids[ended]):
                    out[row] = done[:length].tobytes()
                if len(ended) == len(rows):
                    return out
                longest = int(lengths[live].max())
                ids, ranks = ids[live, :longest], ranks[live, :longest]
                rows, lengths, at, best = rows[live], lengths[live], at[live], best[live]
                own = np.arange(len(rows))
            # Columns behind the merge move up by one; the merged id is its rank.
            source = np.arange(ids.shape[1] - 1) + (np.arange(ids.shape[1] - 1) > at[:, None])
            ids = np.concatenate([np.take_along_axis(ids, source, 1), np.full((len(rows), 1), -1, np.int32)], 1)
            ranks = np.concatenate([np.take_along_axis(ranks, source, 1), np.full((len(rows), 1), NONE, np.int32)], 1)
            ids[own, at] = best
            lengths = lengths - 1
            after = np.minimum(at + 1, ids.shape[1] - 1)
            ranks[own, at] = np.where(at + 1 < lengths, self.pairs.find(best, ids[own, after]), NONE)
            left = np.flatnonzero(at > 0)
            before = at[left] - 1
            ranks[left, before] = self.pairs.find(ids[left, before], best[left])

    def _queued(self, run: bytes) -> bytes:
        """Ids of a very long run of bytes: a queue of ranks and places over a linked list of ids."""
        ids = array("i", self.of_byte[np.frombuffer(run, np.uint8)].tobytes())
        n, merge = len(ids), self.merge
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        first = self.pairs.find(np.frombuffer(ids, np.int32)[:-1], np.frombuffer(ids, np.int32)[1:])
        live = np.flatnonzero(first != NONE)
        # Rank and place in one integer: the lowest rank comes first, and of equal ones the leftmost.
        queue = np.sort((first[live].astype(np.int64) << 32) | live).tolist()
        while queue:
            r, i = divmod(heapq.heappop(queue), 1 << 32)
            j = after[i]
            if ids[i] < 0 or j >= n or merge.get((ids[i], ids[j])) != r:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := merge.get((r, ids[k]))) is not None:
                    heapq.heappush(queue, (s << 32) | i)
            h = before[i]
            if h >= 0 and (s := merge.get((ids[h], r))) is not None:
                heapq.heappush(queue, (s << 32) | h)
        left = np.frombuffer(ids, np.int32)
        return left[left >= 0].tobytes()

    def _runs(self, word: bytes) -> list[bytes]:
        """A long word cut where no entry spans two bytes."""
        data = np.frombuffer(word, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.spanned[data[:-1], data[1:]]) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of each distinct word."""
        found: dict[bytes, bytes] = {}
        buckets: list[list[bytes]] = [[] for _ in WIDTHS]
        short, long_words, runs = [], [], set()
        for word in words:
            r = self.rank.get(word)
            if r is not None:
                found[word] = r.to_bytes(4, "little")
            elif len(word) <= WIDTHS[-1]:
                short.append(word)
            else:
                long_words.append(word)
                runs.update(self._runs(word))
        parts = {**dict.fromkeys(short), **dict.fromkeys(r for r in runs if len(r) <= WIDTHS[-1])}
        if parts:
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            for word, k in zip(parts, np.searchsorted(WIDTHS, lengths).tolist()):
                buckets[k].append(word)
        encoded: dict[bytes, bytes] = {}
        for width, bucket in zip(WIDTHS, buckets):
            step = max(1, CELLS // width)
            for i in range(0, len(bucket), step):
                chunk = bucket[i : i + step]
                encoded.update(zip(chunk, self._rounds(chunk, width)))
        for word in short:
            found[word] = encoded[word]
        for word in long_words:
            found[word] = b"".join(encoded[r] if r in encoded else self._queued(r) for r in self._runs(word))
        return found

    # ---- texts -----------------------------------------------------------------------------------

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not kept; keeps the short ones."""
        older = self._older
        learnt = {w: older[w] for w in words if w in older}
        fresh = {w: w.encode() for w in words if w not in learnt}
        ids = self.encode_words(fresh.values())
        learnt.update((w, ids[data]) for w, data in fresh.items())
        self._kept.update((w, x) for w, x in learnt.items() if len(w) <= LONGEST_KEPT)
        return learnt

    def _joined(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as words; the new words of all of them are encoded together."""
        if len(self._kept) > KEPT_WORDS:
            self._older, self._kept = self._kept, {}
        kept = self._kept
        learnt = self._learn(set().union(*texts).difference(kept))
        out = []
        for words in texts:
            try:
                out.append(b"".join(map(kept.__getitem__, words)))
            except KeyError:  # a long word
                out.append(b"".join([kept.get(w) or learnt[w] for w in words]))
        return out

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids of a long text, a bounded number of words at a time."""
        found = WORDS.finditer(text)
        while words := [m.group() for m in islice(found, PART_WORDS)]:
            yield self._joined([words])[0]

    def encode(self, texts: list[str]) -> Iterator[Iterable[bytes]]:
        """Ids of each text as little-endian 32-bit integers, in parts to be joined."""
        group: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > GROUP:
                yield from ((ids,) for ids in self._joined([WORDS.findall(t) for t in group]))
                group, size = [], 0
            if len(text) > GROUP:
                yield self.parts(text)
            else:
                group.append(text)
                size += len(text)
        yield from ((ids,) for ids in self._joined([WORDS.findall(t) for t in group]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.entry.__getitem__, np.frombuffer(ids, np.uint32).tolist()))


@lru_cache(maxsize=2)
def model(path: str) -> BytePairs:
    return BytePairs(path)


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, hashes of the ids as little-endian
    32-bit integers and of the bytes they decode to; ``with_ids`` adds ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model(path)
        for batch, texts in texts_of(batches, text):
            counts, hashes, decoded, kept = [], [], [], []
            for parts in pairs.encode(texts):
                n, own, back, ids = 0, sha256(), sha256(), []
                for part in parts:
                    n += len(part) // 4
                    own.update(part)
                    back.update(pairs.decode(part))
                    if with_ids:
                        ids.append(part)
                counts.append(n)
                hashes.append(own.hexdigest())
                decoded.append(back.hexdigest())
                if with_ids:
                    kept.append(np.frombuffer(b"".join(ids), np.int32))
            columns = [batch.column(key), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    kind = docs.schema[key].dataType.simpleString()
    result = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(run, result + (", ids array<int>" if with_ids else ""))


def decoded(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key and ``text``, the text that the ids stand for; what is no UTF-8 becomes U+FFFD.

    NULL ids give the empty text; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model(path)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = [b"".join(map(pairs.entry.__getitem__, x or ())).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())], names=[key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
