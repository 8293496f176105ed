"""Exact token counts of every prefix, for byte-level BPE vocabularies.

The token sequence of a byte string is built left to right: exactly one vocabulary entry ``t`` ends
at position ``i`` such that the last token of the prefix before it and ``t`` would stay apart under
the merge rules. So ``count[i] = count[i - len(t)] + 1``, and one pass gives the count of every
prefix (prefix dynamic programming). Texts are cut into words by the vocabulary's pattern first; the
counts of a word are kept for the next time it comes up.

With the counts, truncation and budget questions need no further encoding: ``count_at`` gives the
tokens of any prefix, ``longest_within`` the longest prefix that fits a budget.

NULL and empty texts have 0 tokens. Very long words are handled in time linear in their length.
Repeated rows give repeated results. Other columns of the input are not read.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from forktide.llm.common import texts_of

# Words kept per Python worker, in two generations: when the younger one is full it becomes the
# older one, so common words stay and memory is bounded.
KEPT_WORDS = 600_000
KEPT_PAIRS = 2_000_000
LONGEST_KEPT = 48  # code points, so a count fits a byte

# The word pattern of the public byte-level vocabularies, and their byte alphabet
# (printable bytes stand for themselves, the others for code points from 256 on).
WORDS = regex.compile(
    r" ?\p{L}++| ?\p{N}++|'(?:[stmd]|re|ve|ll)| ?[^\p{White_Space}\p{L}\p{N}]++"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CONTRACTIONS = ("'re", "'ve", "'ll")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_of_char() -> dict[str, int]:
    other = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(other)}


class PrefixCounter:
    """Counts tokens of prefixes under the vocabulary file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_of_char()

        def as_bytes(piece: str) -> bytes:
            return bytes(alphabet[c] for c in piece)

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.made: dict[bytes, tuple[bytes, bytes, int]] = {}
        for r, (a, b) in enumerate(merges):
            left, right = as_bytes(a), as_bytes(b)
            self.rank[left, right] = r
            self.made.setdefault(left + right, (left, right, r))
        self.tokens = {bytes([b]) for b in range(256)} | set(self.made)
        self.longest = [1] * 256
        for t in self.tokens:
            self.longest[t[-1]] = max(self.longest[t[-1]], len(t))
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # Per last token, whether a token may follow it.
        self._after: dict[bytes, dict[bytes, bool]] = {b"": {}}
        self._pairs = 0
        self._right: dict[bytes, list[tuple[bytes, int]]] = {}
        self._left: dict[bytes, list[tuple[bytes, int]]] = {}
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _edge(self, token: bytes, side: int, kept: dict[bytes, list[tuple[bytes, int]]]) -> list[tuple[bytes, int]]:
        """Parts of ``token`` at one of its ends, each with the rank of the merge that absorbs it."""
        if token not in kept:
            parts, absorbed = [], len(self.rank)
            part = token
            while True:
                parts.append((part, absorbed))
                if part not in self.made:
                    break
                absorbed, part = self.made[part][2], self.made[part][side]
            kept[token] = parts
        return kept[token]

    def apart(self, a: bytes, b: bytes) -> bool:
        """Whether no merge crosses the border of ``a`` and ``b`` while both are being built."""
        rank = self.rank
        for x, until_x in self._edge(a, 1, self._right):
            for y, until_y in self._edge(b, 0, self._left):
                r = rank.get((x, y))
                if r is not None and r < until_x and r <= until_y:
                    return False
        return True

    def of_bytes(self, word: bytes) -> list[int]:
        """Counts of all prefixes of one word, by byte."""
        n = len(word)
        count, after = [0] * (n + 1), [self._after[b""]] * (n + 1)
        tokens, longest, known = self.tokens, self.longest, self._after
        last = [b""] * (n + 1)
        for i in range(1, n + 1):
            for j in range(i - 1, max(-1, i - 1 - longest[word[i - 1]]), -1):
                t, row = word[j:i], after[j]
                fits = row.get(t)
                if fits is None:
                    if t not in tokens:
                        continue
                    fits = row[t] = j == 0 or self.apart(last[j], t)
                    self._pairs += 1
                if fits:
                    count[i], last[i] = count[j] + 1, t
                    after[i] = known.get(t)
                    if after[i] is None:
                        after[i] = known[t] = {}
                    break
        if self._pairs > KEPT_PAIRS:
            self._after, self._pairs = {b"": {}}, 0
        return count

    def of_word(self, word: str) -> bytes | list[int]:
        """Counts of the prefixes of one word, by code point from 1 on; the last is its total."""
        known = self._words.get(word)
        if known is not None:
            return known
        known = self._older.get(word)
        if known is None:
            data = word.encode()
            known = self.of_bytes(data)[1:]
            if len(data) > len(word):
                # A code point ends where the next byte does not continue it.
                known = [c for c, b in zip(known, data[1:] + b" ") if b & 0xC0 != 0x80]
            if word in CONTRACTIONS:
                # A contraction that is cut short is an apostrophe and a letter, two words.
                known = [1, 2, known[2]]
            if len(word) > LONGEST_KEPT:
                return known
            known = bytes(known)
        if len(self._words) >= KEPT_WORDS:
            self._older, self._words = self._words, {}
        self._words[word] = known
        return known

    def words(self, text: str) -> list[str]:
        return WORDS.findall(text)

    def _parts(self, text: str) -> list[tuple[bool, str]]:
        if self.split is None or not any(s in text for s in self.special):
            return [(False, text)]
        return [(i % 2 == 1, p) for i, p in enumerate(self.split.split(text)) if p]

    def totals(self, text: str) -> list[tuple[str, int]]:
        """Words of a text in order with their token counts."""
        out = []
        for special, part in self._parts(text):
            if special:
                out.append((part, 1))
            else:
                out.extend((w, self.of_word(w)[-1]) for w in self.words(part))
        return out

    def count(self, text: str) -> int:
        if self.split is not None and any(s in text for s in self.special):
            return sum(n for _, n in self.totals(text))
        get, of_word = self._words.get, self.of_word  # the store may be replaced meanwhile: only slower
        return sum([(get(w) or of_word(w))[-1] for w in WORDS.findall(text)])

    def prefixes(self, text: str) -> list[int]:
        """Tokens of ``text[:i]`` for i = 0 .. len(text)."""
        out, before, tail = [0], 0, ""
        for special, part in self._parts(text):
            if special:
                # Cut within it, the string is plain text that goes on from the words before it.
                inside = self.prefixes_of_plain(tail + part)
                base = before - self.prefixes_of_plain(tail)[-1]
                out.extend(base + n for n in inside[len(tail) + 1 : -1])
                out.append(before + 1)
                before, tail = before + 1, ""
            else:
                inside = self.prefixes_of_plain(part)
                out.extend(before + n for n in inside[1:])
                before = out[-1]
                tail = "".join(WORDS.findall(part)[-2:])
        return out

    def prefixes_of_plain(self, text: str) -> list[int]:
        out, before, words = [0], 0, WORDS.findall(text)
        for k, word in enumerate(words):
            counts = self.of_word(word)
            first = counts[0]
            if k and words[k - 1].isspace() and word[0].isspace():
                # Cut after this blank, the blanks before it would be one word with it.
                first = self.of_word(words[k - 1] + word[0])[-1] - self.of_word(words[k - 1])[-1]
            out.append(before + first)
            out.extend(before + n for n in counts[1:])
            before += counts[-1]
        return out

    def count_at(self, text: str, end: int) -> int:
        """Tokens of the first ``end`` code points."""
        return self.prefixes(text)[end]

    def longest_within(self, text: str, budget: int) -> int:
        """Code points of the longest prefix that has at most ``budget`` tokens.

        Counts before a word only grow from word to word, so the answer lies near the last word that
        begins within the budget; only the words around it are looked at by code point.
        """
        words = self.totals(text)
        starts = list(accumulate((n for _, n in words), initial=0))
        if starts[-1] <= budget:
            return len(text)
        k = bisect_right(starts, budget)
        at = sum(len(w) for w, _ in words[: max(0, k - 2)])
        until = at + sum(len(w) for w, _ in words[max(0, k - 2) : k + 1])
        base = starts[max(0, k - 2)]
        inside = self.prefixes(text[at:until])
        return at + max(i for i, n in enumerate(inside) if base + n <= budget)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", budget: int = 512) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_tokens``, and ``fit_chars``, the longest prefix within budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch, texts in texts_of(batches, text):
            counts = [model.count(t) for t in texts]
            fits = [len(t) if n <= budget else model.longest_within(t, budget) for t, n in zip(texts, counts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(fits, pa.int64()),
                ],
                names=[key, "n_bytes", "n_tokens", "fit_chars"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, fit_chars bigint")


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``prefix_tokens``, the counts of all prefixes from 0 code points on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch, texts in texts_of(batches, text):
            for i, t in enumerate(texts):  # one row at a time: the arrays are larger than the texts
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(i, 1), pa.array([model.prefixes(t)], pa.list_(pa.int32()))],
                    names=[key, "prefix_tokens"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, prefix_tokens array<int>")
