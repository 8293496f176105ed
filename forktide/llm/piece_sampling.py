"""Sampling distinct segmentations of a text into vocabulary pieces, without replacement.

All segmentations of a text are the paths of a lattice; a path's weight is the product of its pieces'
weights. Gumbel top-k draws the k paths of the highest perturbed log probability: the top one is an
ordinary sample, and the others follow without replacement. They are found by a perturbed best-first
(A-star) search over sets of paths: after a path was taken, the remaining paths of its set fall into
one set for every position, those that agree with it up to there and differ next. A set's bound is
the largest perturbed score in it, a Gumbel variable truncated by the bound of the set it was in, so
only the set of the highest bound is ever opened; sets get a bound once they could be that. The inclusion score of a path is the probability
that its score is above that of the best path not taken, ``1 - exp(-exp(log_prob - bound))``.

Weights: a piece of rank r among the merges weighs ``(r + 2) ** -SHARPNESS``; characters without a
piece become byte pieces. Random numbers are drawn by hashing the row's key with the position, so a
row has the same samples wherever and with whatever other rows it is processed.

Pieces never run past a blank or line end, so lattices are built once per distinct word (found by hash, then compared), and those of
some ``KEPT_NODES`` characters of words are kept; beyond that, words that did not come up again are
forgotten. A group has some ``GROUP_CHARS`` characters, and at least
one text.

Defined results: NULL and empty texts have one segmentation, the empty one, and thus one row. A text
of fewer than k segmentations gets all of them, with inclusion score 1. Rows without key share one
seed. Repeated rows get equal samples. The vocabulary writes blanks as U+2581, so a text that holds
this character decodes to one with blanks.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forktide.llm.common import give_back

BLANK = "▁"
SAMPLES = 4
SHARPNESS = 1.0
GROUP_CHARS = 400_000
KEPT_NODES = 500_000  # characters of the words whose lattices are kept from group to group
LONG = 512  # characters of a word beyond which its nodes are taken one by one
ADDED = 100_000  # characters of words that are added together
FEW = 8  # words that are walked together at least
PART = 1 << 14
HEAD = 32  # pieces of a path by which those near its best set are found
LEAD_BITS = 18
# Random numbers lie between 2 ** -53 and 1 - 2 ** -53, so a Gumbel variable exceeds its location by
# less than HIGHEST; a set whose bound cannot come near the best one needs no random number.
HIGHEST = 37.0

# Hashes of strings: the sum of (code point + 1) * _BASE ** place, places from 1.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LEAD = np.array([0, 0, 0xC0, 0xE0, 0xF0])  # first byte of a character of so many bytes
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Vocabulary:
    """Pieces of a model file, by length and hash."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_id = np.zeros(256, np.int32)
        texts, ids, ranks = [], [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.encode())
                texts.append(piece)
                ids.append(i)
                ranks.append(min(-model.get_score(i), float(n)))
        self.weight = np.zeros(n)
        self.weight[ids] = -sharpness * np.log(np.array(ranks) + 2.0)
        self.byte_weight = -sharpness * np.log(n + 2.0)
        self.longest = max(map(len, texts))
        self.written = pa.array(self.bytes_of, pa.binary())
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        # Per length, leading bits of the hashes of beginnings of longer pieces: where a string has none
        # of them, no longer piece begins.
        self.goes_on: list[np.ndarray] = [np.zeros(0, bool)]
        for length in range(1, self.longest + 1):
            own = [(t, i) for t, i in zip(texts, ids) if len(t) == length]
            powers = np.cumprod(np.full(length, _BASE))

            def hashed(strings: list[str]) -> np.ndarray:
                points = np.array([[ord(c) for c in t] for t in strings], np.uint64).reshape(-1, length)
                return ((points + np.uint64(1)) * powers).sum(1, dtype=np.uint64)

            goes_on = np.zeros(1 << LEAD_BITS, bool)
            goes_on[hashed(sorted({t[:length] for t in texts if len(t) > length})) >> np.uint64(64 - LEAD_BITS)] = True
            self.goes_on.append(goes_on)
            if own:
                hashes = hashed([t for t, _ in own])
                order = np.argsort(hashes)
                hashes = hashes[order]
                # Where hashes with the same leading bits begin; most strings are ruled out by them alone.
                bits, begin, runs = np.unique(hashes >> np.uint64(64 - LEAD_BITS), return_index=True, return_counts=True)
                lead = np.full(1 << LEAD_BITS, -1, np.int16 if len(own) < 1 << 15 else np.int32)
                lead[bits] = begin
                self.by_length[length] = (hashes, np.array([i for _, i in own], np.int32)[order], lead, int(runs.max()))


@lru_cache(maxsize=2)
def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    return Vocabulary(path, sharpness)


@lru_cache(maxsize=2)
def kept_lattice(path: str) -> Lattice:
    """The lattice of a worker, kept from task to task."""
    return Lattice(vocabulary(path))


def _grown(buffer: np.ndarray, used: int, more: int) -> np.ndarray:
    """The buffer with room for ``more`` entries after the first ``used``."""
    if used + more <= len(buffer):
        return buffer
    out = np.empty(max(used + more, used + used // 2), buffer.dtype)
    out[:used] = buffer[:used]
    return out


class Lattice:
    """Lattices of distinct words, laid end to end; words are added when they first come up.

    A node is a character position. The edges of a node are neighbours in the edge arrays: ``piece``
    (-1: byte pieces of the character), ``size`` in characters (both as narrow as the vocabulary allows),
    ``log_p`` (log probability of the edge given the node) and ``upto`` (sum of the probabilities up to it); ``below`` is that sum for the last
    edge but one of a node, -1 if there is one edge only. ``again`` counts by word the groups in which it
    came up again.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()
        self.start, self.chars = np.empty(0, np.int32), np.empty(0, np.int32)  # of words, by number: first node, size
        self.again = np.empty(0, np.int32)
        self.points = np.empty(0, np.uint32)
        self.first, self.last, self.below = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0)
        self.size = np.empty(0, np.min_scalar_type(v.longest))
        self.piece = np.empty(0, np.promote_types(np.int16, np.min_scalar_type(-len(v.bytes_of))))
        self.log_p, self.upto = np.empty(0), np.empty(0)

    def clear(self) -> None:
        """Forget all words; their room is used again."""
        self.hashes, self.number = np.empty(0, np.uint64), np.empty(0, np.int32)  # of words, by hash
        self.nodes = self.edges = self.added = 0

    def forget(self) -> None:
        """Forget the words that did not come up again; of the others the most frequent ones stay, up to
        half of the room. They lie in that order, each with its edges side by side."""
        again = self.again[: self.added]
        words = np.flatnonzero(again)
        words = words[np.argsort(-again[words], kind="stable")]
        words = words[np.cumsum(self.chars[words], dtype=np.int64) <= KEPT_NODES // 2]
        number = np.full(self.added, -1, np.int32)
        number[words] = np.arange(len(words))
        number = number[self.number]
        hashes, number = self.hashes[number >= 0], number[number >= 0]
        chars = self.chars[words]
        start = np.cumsum(chars) - chars
        nodes = np.arange(chars.sum()) + np.repeat(self.start[words] - start, chars)
        counts = self.last[nodes] - self.first[nodes] + 1
        first = np.cumsum(counts) - counts
        edges = np.arange(counts.sum()) + np.repeat(self.first[nodes] - first, counts)
        self._put(0, start=start, chars=chars, again=np.zeros(len(words), np.int32))
        self._put(0, first=first, last=first + counts - 1)
        for chosen, names in ((nodes, ("points", "below")), (edges, ("size", "piece", "log_p", "upto"))):
            for name in names:  # one by one, which needs the least memory
                self._put(0, **{name: getattr(self, name)[chosen]})
        self.hashes, self.number = hashes, number
        self.nodes, self.edges, self.added = len(nodes), len(edges), len(words)

    def _put(self, used: int, **columns: np.ndarray) -> None:
        for name, values in columns.items():
            buffer = _grown(getattr(self, name), used, len(values))
            buffer[used : used + len(values)] = values
            setattr(self, name, buffer)

    def numbers(self, points: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of the words that ``points`` is cut into, whose lattices are there from now on."""
        place = np.arange(len(points), dtype=np.int32) - np.repeat(start, sizes)
        power = np.cumprod(np.full(int(sizes.max(initial=0)), _BASE))
        own = np.add.reduceat((points + np.uint64(1)) * power[place], start) if len(start) else np.empty(0, np.uint64)
        hashes, first, of = np.unique(own, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        number = np.empty(len(hashes), np.int32)
        number[known] = self.number[at[known]]
        self.again[number[known]] += 1
        met = new[np.argsort(first[new])]  # in the order in which they are walked
        number[met] = self.added + np.arange(len(met))
        self.hashes = np.insert(self.hashes, at[new], hashes[new])
        self.number = np.insert(self.number, at[new], number[new])
        self._add_some(points, start[first[met]], sizes[first[met]])
        number = number[of]
        # Words that only share a hash get lattices of their own.
        place += np.repeat(self.start[number], sizes)
        same = self.points[np.minimum(place, self.nodes - 1)] == points
        if not same.all() or (self.chars[number] != sizes).any():
            other = np.flatnonzero(~np.logical_and.reduceat(same, start) | (self.chars[number] != sizes))
            number[other] = self.added + np.arange(len(other))
            self._add_some(points, start[other], sizes[other])
        return number

    def _add_some(self, points: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> None:
        """Lattices of words within ``points``, some ``ADDED`` characters at a time."""
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // ADDED)) + 1
        for some, lengths in zip(np.split(start, cuts), np.split(sizes, cuts)):
            ends = np.cumsum(lengths)
            self.add(points[np.arange(lengths.sum()) + np.repeat(some - ends + lengths, lengths)], lengths)

    def add(self, points: np.ndarray, lengths: np.ndarray) -> None:
        """Lattices of the words next in number, laid end to end."""
        v = self.v
        end = np.cumsum(lengths)
        start = end - lengths
        n = len(points)
        left = np.repeat(end, lengths) - np.arange(n)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((points + np.uint64(1)) * power[:n], dtype=np.uint64)])
        inverse = np.cumprod(np.concatenate([[_BASE], np.full(n, _INVERSE)]))
        del power
        at, sizes, pieces = [], [], []
        alive = np.arange(n, dtype=np.int32)
        for length in range(1, v.longest + 1):
            alive = alive.take(np.flatnonzero(left[alive] >= length))
            if not len(alive):
                break
            found = np.zeros(len(alive), bool)
            own = (sums[alive + length] - sums[alive]) * inverse[alive]
            bits = own >> np.uint64(64 - LEAD_BITS)
            if length in v.by_length:
                hashes, ids, lead, longest_run = v.by_length[length]
                where = lead[bits].astype(np.int64)
                likely = np.flatnonzero(where >= 0)
                where, hash_ = where.take(likely), own.take(likely)
                for _ in range(longest_run - 1):
                    where += (hashes[where] < hash_) & (where + 1 < len(hashes))
                equal = np.flatnonzero(hashes[where] == hash_)
                likely = likely.take(equal)
                found[likely] = True
                at.append(alive.take(likely))
                sizes.append(length)
                pieces.append(ids[where.take(equal)])
            if length == 1:
                at.append(alive[~found])
                sizes.append(1)
                pieces.append(np.full((~found).sum(), -1, np.int32))
            alive = alive.take(np.flatnonzero(v.goes_on[length][bits]))
        del sums, inverse
        # Nodes by their distance from the end of the word; edges lie beside each other in that order.
        small = n == 0 or left.max() < 1 << 16
        nodes = np.argsort(left.astype(np.uint16) if small else left, kind="stable").astype(np.int32)
        edges_of = np.zeros(n, np.int32)
        for some in at:
            edges_of[some] += 1
        first = np.zeros(n, np.int32)
        first[nodes] = np.concatenate([[0], np.cumsum(edges_of[nodes])[:-1]]) if n else 0
        total = int(edges_of.sum())
        e_at = np.repeat(nodes, edges_of[nodes])
        e_size, e_piece = np.empty(total, np.int16), np.empty(total, np.int32)
        free = first.copy()
        for some, length, ids in zip(at, sizes, pieces):
            place = free[some]
            free[some] += 1
            e_size[place], e_piece[place] = length, ids
        del at, pieces, free
        values = v.weight[e_piece]
        raw = np.flatnonzero(e_piece < 0)
        c = points[e_at[raw]]
        values[raw] = v.byte_weight * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))
        # Log sums of the paths from each node to the end of its word, from the end backwards; past the
        # end of a word there is one path, the empty one.
        rest = np.zeros(n + 1)
        levels = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=1))])
        for level in range(1, min(len(levels) - 1, LONG + 1)):
            own = nodes[levels[level] : levels[level + 1]]
            if not len(own):
                continue
            a, b = first[own[0]], first[own[-1]] + edges_of[own[-1]]
            values[a:b] += np.where(e_size[a:b] == level, 0.0, rest[np.minimum(e_at[a:b] + e_size[a:b], n)])
            cuts = first[own] - a
            top = np.maximum.reduceat(values[a:b], cuts)
            spread = np.repeat(top, edges_of[own])
            rest[own] = top + np.log(np.add.reduceat(np.exp(values[a:b] - spread), cuts))
        if len(levels) - 1 > LONG + 1:
            self._backwards(nodes[levels[LONG + 1] :], first, edges_of, e_size, values, rest)
        log_p = np.minimum(values - rest[e_at], 0.0)
        del values, rest
        upto = np.exp(log_p)
        # Sums within each node, edge by edge, so they do not depend on the other words.
        for k in range(1, int(edges_of.max(initial=0))):
            more = first[edges_of > k] + k
            upto[more] += upto[more - 1]
        below = np.where(edges_of > 1, upto[first + edges_of - 2], -1.0)
        self._put(self.added, start=start + self.nodes, chars=lengths, again=np.zeros(len(lengths), np.int32))
        self.added += len(lengths)
        self._put(self.nodes, points=points, first=first + self.edges, last=first + edges_of + (self.edges - 1), below=below)
        self._put(self.edges, size=e_size, piece=e_piece, log_p=log_p, upto=upto)
        self.nodes += n
        self.edges += total

    @staticmethod
    def _backwards(nodes, first, edges_of, size, values, rest) -> None:
        """The log sums of very long words, where a level is a node or two: node by node."""
        log, exp = math.log, math.exp
        known = array("d", rest.tobytes())
        for i in range(0, len(nodes), PART):
            own = nodes[i : i + PART]
            lo = int(first[own[0]])
            hi = int(first[own[-1]] + edges_of[own[-1]])
            sums, sizes = values[lo:hi].tolist(), size[lo:hi].tolist()
            for node, a, m in zip(own.tolist(), (first[own] - lo).tolist(), edges_of[own].tolist()):
                top = -math.inf
                for e in range(a, a + m):
                    sums[e] = x = sums[e] + known[node + sizes[e]]
                    if x > top:
                        top = x
                known[node] = top + log(sum([exp(x - top) for x in sums[a : a + m]]))
            values[lo:hi] = sums
        rest[:] = np.frombuffer(known)


def _mixed(seed: np.ndarray, stream: int, start: np.ndarray | int = 0) -> np.ndarray:
    """The part of ``uniform`` that does not depend on the position, for positions counted from ``start``."""
    with np.errstate(over="ignore"):
        x = seed.astype(np.uint64) ^ (np.uint64(stream + 1) * np.uint64(0xD1342543DE82EF95))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x + (np.uint64(1) - np.asarray(start).astype(np.uint64)) * _BASE


def _drawn(mixed: np.ndarray, position: np.ndarray) -> np.ndarray:
    x = position.astype(np.uint64)
    x *= _BASE
    x += mixed
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(12)
    x |= np.uint64(0x3FF << 52)  # 1 + 52 bits, as a float
    out = x.view(np.float64)
    out -= 1.0 - 1.0 / (1 << 53)
    return out


def uniform(seed: np.ndarray, stream: int, position: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by hashing seed, stream and position."""
    return _drawn(_mixed(seed, stream), position)


def _below(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of the given locations, truncated to lie below the bounds."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = location - np.log(np.exp(location - bound) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, np.minimum(out, bound))


def _log_rest(log_p: np.ndarray) -> np.ndarray:
    """Log of what an edge of the given log probability leaves to the others of its node."""
    rest = 1.0 - np.exp(log_p)
    return np.where(rest > 1e-12, np.log(np.maximum(rest, 1e-300)), -np.inf)


class _Group:
    """Some texts, their words, and the paths taken so far.

    Of a path only the characters where a piece begins are kept: ``place``, with the edge taken there,
    minus the log probabilities ``spent`` before it, and the ``bound`` of the set of paths that leave it there.
    """

    def __init__(self, texts: list[str], seeds: np.ndarray, lattice: Lattice):
        if lattice.nodes > KEPT_NODES:
            lattice.forget()
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int32)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int32)
        # A word is blanks and what follows them up to a blank or line end; a line end is a word.
        blank, line = points == ord(BLANK), points == ord("\n")
        begins = blank | line
        begins[1:] &= ~(blank[1:] & blank[:-1])
        begins[1:] |= line[:-1]
        begins[self.starts] = True
        self.word_start = np.flatnonzero(begins).astype(np.int32)  # by occurrence, in characters of the group
        self.word_end = np.append(self.word_start[1:], np.int32(len(points)))
        number = lattice.numbers(points, self.word_start, self.word_end - self.word_start)
        self.lattice = lattice
        self.shift = lattice.start[number] - self.word_start
        counts = np.diff(np.searchsorted(self.word_start, self.starts), append=len(self.word_start))
        self.word_text = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
        self.seeds = seeds
        self.place: list[np.ndarray] = []
        self.edge: list[np.ndarray] = []
        self.spent: list[np.ndarray] = []
        self.bound: list[np.ndarray] = []
        self.part: list[np.ndarray] = []  # where the texts begin in these arrays
        self.log_p: list[np.ndarray] = []  # of the texts' paths
        # Sets left without a bound as they cannot be the next: the most it can be, and how it is drawn.
        self.put_off: list[np.ndarray] = []
        self.drawn: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.excluded: dict[tuple[int, int], list[int]] = {}

    def walk(self, stream: int, at: np.ndarray, occurrence: np.ndarray, edge: np.ndarray) -> None:
        """Sample on from the characters ``at`` to the ends of their words, into ``edge``."""
        lat = self.lattice
        shift, end = self.shift[occurrence], self.word_end[occurrence]
        mixed = _mixed(self.seeds, stream, self.starts)[self.word_text[occurrence]]
        while len(at) > FEW:
            node = at + shift
            u = _drawn(mixed, at)
            # The first edge whose sum reaches u, from the last one back: longer pieces are likelier.
            e = lat.last[node]
            open_ = np.flatnonzero(u <= lat.below[node])
            back, first, drawn = e.take(open_) - 1, lat.first[node.take(open_)], u.take(open_)
            while len(open_):
                e[open_] = back
                on = np.flatnonzero((back > first) & (drawn <= lat.upto[back - 1]))
                open_, back, first, drawn = open_.take(on), back.take(on) - 1, first.take(on), drawn.take(on)
            edge[at] = e
            at = at + lat.size[e]
            on = np.flatnonzero(at < end)
            at, shift, end, mixed = at.take(on), shift.take(on), end.take(on), mixed.take(on)
        for one in zip(at.tolist(), shift.tolist(), end.tolist(), mixed):
            self._walk_one(*one, edge)

    def _walk_one(self, at: int, shift: int, end: int, mixed: np.uint64, edge: np.ndarray) -> None:
        """The same for one word, step by step."""
        lat = self.lattice
        while at < end:
            base, stop = at, min(at + PART, end)
            place = np.arange(base, stop)
            numbers = _drawn(mixed, place).tolist()
            lo = lat.first[place + shift].tolist()
            hi = lat.last[place + shift].tolist()
            upto, size = lat.upto, lat.size
            while at < stop:
                e, last, u = lo[at - base], hi[at - base], numbers[at - base]
                while e < last and u > upto[e]:
                    e += 1
                edge[at] = e
                at += int(size[e])

    def add_path(self, edge: np.ndarray, bound: np.ndarray, begin: np.ndarray, stream: int) -> None:
        """Take a path per text (``edge`` by character, -1 inside pieces), which opens new sets from ``begin``."""
        lat = self.lattice
        at = np.flatnonzero(edge >= 0).astype(np.int32)
        edge = edge[at]
        part = np.append(np.searchsorted(at, self.starts), len(at))
        log_p = lat.log_p[edge]
        some = np.flatnonzero(part[1:] > part[:-1])
        total = np.zeros(len(self.starts))  # 0 where a text has no such path
        if len(some):
            total[some] = np.add.reduceat(log_p, part[some])
        spent = np.concatenate([[0.0], np.cumsum(-log_p)])  # so far, over all texts
        lead = np.clip(np.searchsorted(at, begin), part[:-1], part[1:])

        def masses(stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """Edges from ``lead`` to ``stop``, their texts, the masses of the sets there, and each text's largest."""
            counts = stop - lead
            own = np.repeat(np.arange(len(lead), dtype=np.int32), counts)
            i = np.arange(len(own)) + np.repeat(stop - np.cumsum(counts), counts)
            mass = spent[part[own]] - spent[i] + _log_rest(log_p[i])
            most = np.full(len(lead), -np.inf)
            np.maximum.at(most, own, mass)
            return i, own, mass, most

        def least(most: np.ndarray) -> np.ndarray:
            """The set of the largest mass has at least this bound, whatever is drawn."""
            with np.errstate(over="ignore", invalid="ignore"):
                return most - np.log(np.exp(np.minimum(most - bound, 700.0)) + HIGHEST)

        # Masses fall behind what the path has spent, so those near the best lie at its beginning.
        far = least(masses(np.minimum(lead + HEAD, part[1:]))[3]) - HIGHEST
        stop = np.clip(np.searchsorted(spent[:-1], spent[part[:-1]] - far + 1e-6, side="right"), lead, part[1:])
        i, own, mass, most = masses(stop)
        is_far = mass + HIGHEST < least(most)[own]
        put_off = np.full(len(self.starts), -np.inf)
        np.maximum.at(put_off, own[is_far], mass[is_far])
        beyond = np.flatnonzero(stop < part[1:])
        put_off[beyond] = np.maximum(put_off[beyond], spent[part[beyond]] - spent[stop[beyond]])
        self.put_off.append(put_off + HIGHEST)
        self.drawn.append((begin, bound, stream))
        near = ~is_far & np.isfinite(mass)
        i, own, mass = i[near], own[near], mass[near]
        u = uniform(self.seeds[own], stream, at[i] - self.starts[own])
        limit = np.full(len(at), -np.inf)
        limit[i] = _below(mass, bound[own], u)
        self.place.append(at)
        self.edge.append(edge)
        self.spent.append(spent)
        self.bound.append(limit)
        self.part.append(part)
        self.log_p.append(total)

    def _settle(self, path: int, text: int) -> None:
        """Draw the bounds of a text's sets that were put off."""
        begin, bound, stream = self.drawn[path]
        a, b = self.part[path][text : text + 2]
        at, old = self.place[path][a:b], self.bound[path][a:b]
        spent = self.spent[path]
        mass = spent[a] - spent[a:b] + _log_rest(self.lattice.log_p[self.edge[path][a:b]])
        left = np.isneginf(old) & np.isfinite(mass) & (at >= begin[text])
        left &= [(path, x) not in self.excluded for x in at.tolist()]  # a set that was opened has its bound
        place = at[left] - self.starts[text]
        u = uniform(np.full(len(place), self.seeds[text]), stream, place)
        old[left] = _below(mass[left], np.full(len(place), bound[text]), u)
        self.put_off[path][text] = -np.inf

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """The largest bound of each text's sets, and the path it belongs to."""
        while True:
            top, path = self._best()
            late = [(q, t) for q, most in enumerate(self.put_off) for t in np.flatnonzero(most > top).tolist()]
            if not late:
                return top, path
            for q, t in late:
                self._settle(q, t)

    def _best(self) -> tuple[np.ndarray, np.ndarray]:
        """The same among the sets that have a bound."""
        tops = []
        for bound, part in zip(self.bound, self.part):
            top = np.full(len(self.starts), -np.inf)
            some = np.flatnonzero(part[1:] > part[:-1])  # a text has no path once all are taken
            if len(some):
                top[some] = np.maximum.reduceat(bound, part[some])
            tops.append(top)
        tops = np.array(tops)
        return tops.max(0), tops.argmax(0)

    def branch(self, path: np.ndarray, top: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
        """Open the best set of each text: a new path (``edge``) and where it leaves the old one."""
        lat = self.lattice
        n = int(self.ends[-1])
        edge = np.full(n, -1, np.int32)
        leave = np.full(len(self.starts), n, np.int64)
        open_ = np.flatnonzero(np.isfinite(top))
        where = {}
        for t in open_.tolist():
            q = int(path[t])
            a, b = self.part[q][t : t + 2]
            i = where[t] = a + int(np.flatnonzero(self.bound[q][a:b] == top[t])[0])
            leave[t] = self.place[q][i]
            edge[self.place[q][a:i]] = self.edge[q][a:i]
        u = uniform(self.seeds, stream, leave - self.starts)
        again = uniform(self.seeds, stream + 1, leave - self.starts)
        resume, words = [], []
        for t, i in where.items():
            q, at = int(path[t]), int(leave[t])
            taken = self.excluded.setdefault((q, at), [int(self.edge[q][i])])
            node = at + int(self.shift[np.searchsorted(self.word_end, at, side="right")])
            edges = [e for e in range(lat.first[node], lat.last[node] + 1) if e not in taken]
            p = np.exp(lat.log_p[edges])
            pick = min(int(np.searchsorted(np.cumsum(p), u[t] * p.sum())), len(edges) - 1)
            edge[at] = edges[pick]
            taken.append(edges[pick])
            rest = p.sum() - p[pick]
            before = self.spent[q][self.part[q][t]] - self.spent[q][i]
            left = before + np.log(rest) if rest > 1e-12 else -np.inf
            self.bound[q][i] = _below(np.array([left]), top[t : t + 1], again[t : t + 1])[0]
            resume.append(at + int(lat.size[edges[pick]]))
            words.append(at)
        resume = np.array(resume, np.int32)
        words = np.searchsorted(self.word_end, np.array(words, np.int32), side="right")
        inside = resume < self.word_end[words]
        live = np.isfinite(top)[self.word_text] & (self.word_start > leave[self.word_text])
        later = np.flatnonzero(live)
        self.walk(
            stream + 2,
            np.concatenate([resume[inside], self.word_start[later]]),
            np.concatenate([words[inside], later]),
            edge,
        )
        return edge, leave

    def pieces(self, path: int, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts' paths, and where those of each text begin."""
        lat, edge, part = self.lattice, self.edge[path], self.part[path]
        ids = lat.piece[edge].astype(np.int32)
        raw = np.flatnonzero(ids < 0)
        if not len(raw):
            return ids, part
        at = self.place[path][raw]
        c = lat.points[at + self.shift[np.searchsorted(self.word_end, at, side="right")]].astype(np.int64)
        sizes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        counts = np.ones(len(ids), np.int64)
        counts[raw] = sizes
        begin = np.concatenate([[0], np.cumsum(counts)])
        out = np.repeat(ids, counts)
        for k in range(4):
            some = np.flatnonzero(sizes > k)
            low = (c[some] >> 6 * (sizes[some] - 1 - k)) & 0x3F | 0x80
            lead = _LEAD[sizes[some]] | (c[some] >> 6 * (sizes[some] - 1))
            out[begin[raw[some]] + k] = v.byte_id[low if k else lead]
        return out, begin[part]


def sample(
    texts: list[str], seeds: np.ndarray, v: Vocabulary, k: int = SAMPLES, lattice: Lattice | None = None
) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """For each (not empty) text up to k rows: number of the text, rank from 1, piece ids, log
    probability, perturbed log probability, inclusion score. A ``lattice`` keeps words between calls."""
    group = _Group([BLANK + t.replace(" ", BLANK) for t in texts], seeds, lattice or Lattice(v))
    n = int(group.ends[-1])
    edge = np.full(n, -1, np.int32)
    group.walk(0, group.word_start.copy(), np.arange(len(group.word_start)), edge)
    score = -np.log(-np.log(uniform(seeds, 1, np.zeros(len(texts), np.int64))))
    group.add_path(edge, score, group.starts, 2)
    scores = [score]
    for rank in range(1, k):
        top, path = group.best()
        edge, leave = group.branch(path, top, 10 * rank)
        # At the place where it leaves, the set that remains belongs to the older path.
        group.add_path(edge, top, leave + 1, 10 * rank + 3)
        scores.append(top)
    bound, _ = group.best()
    pieces = [group.pieces(path, v) for path in range(k)]
    for t in range(len(texts)):
        for rank in range(k):
            if not np.isfinite(scores[rank][t]):
                break
            with np.errstate(over="ignore"):
                inclusion = 1.0 if np.isneginf(bound[t]) else float(-np.expm1(-np.exp(group.log_p[rank][t] - bound[t])))
            ids, part = pieces[rank]
            yield t, rank + 1, ids[part[t] : part[t + 1]], float(group.log_p[rank][t]), float(scores[rank][t]), inclusion


def joined(ids: list[np.ndarray], v: Vocabulary) -> Iterator[bytes]:
    """The pieces of each array of ids laid end to end, in UTF-8."""
    ends = np.cumsum([len(x) for x in ids])
    found = v.written.take(pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
    offsets = np.frombuffer(found.buffers()[1], np.int32)
    data = memoryview(found.buffers()[2] or b"")
    for n, end in zip(map(len, ids), ends.tolist()):
        yield bytes(data[offsets[end - n] : offsets[end]])


def decode(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of piece ids."""
    return next(joined([ids], v)).decode(errors="replace").replace(BLANK, " ")[1:]


def segmentations(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", k: int = SAMPLES, with_ids: bool = True
) -> DataFrame:
    """Up to k rows per row of ``docs``.

    Columns: key, ``sample`` (rank from 1), ``n_pieces``, ``log_prob``, ``perturbed``, ``inclusion``,
    ``round_trip`` (whether decoding gives the text back), ``ids_sha256`` (of the ids as little-endian
    32-bit integers), and ``ids`` if asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept_lattice(path)
        for batch in batches:
            # Only a group's texts are Python strings at a time.
            sizes = pc.utf8_length(batch.column(text)).fill_null(0).to_pylist()
            begin = 0
            while begin < len(sizes):
                end, chars = begin, 0
                while end < len(sizes) and (end == begin or chars + sizes[end] <= GROUP_CHARS):
                    chars += sizes[end]
                    end += 1
                yield rows(batch.slice(begin, end - begin), lattice)
                begin = end
            give_back()  # not after each group, which would need the same memory again

    def rows(batch: pa.RecordBatch, lattice: Lattice) -> pa.RecordBatch:
        v = lattice.v
        texts = [t or "" for t in batch.column(text).to_pylist()]
        seeds = batch.column("_seed").to_numpy().view(np.uint64)
        full = [i for i in range(len(texts)) if texts[i]]
        empty = [i for i in range(len(texts)) if not texts[i]]
        found = [(i, 1, np.zeros(0, np.int32), 0.0, 0.0, 1.0) for i in empty]
        if full:
            drawn = sample([texts[i] for i in full], seeds[full], v, k, lattice)
            found += [(full[t], *rest) for t, *rest in drawn]
        ids = [f[2] for f in found]
        wanted = {i: (BLANK + texts[i].replace(" ", BLANK)).encode() if texts[i] else b"" for i in range(len(texts))}
        at = pa.array([f[0] for f in found], pa.int64())
        columns = [
            batch.column(key).take(at),
            pa.array([f[1] for f in found], pa.int32()),
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([f[3] for f in found], pa.float64()),
            pa.array([f[4] for f in found], pa.float64()),
            pa.array([f[5] for f in found], pa.float64()),
            pa.array([b == wanted[f[0]] for f, b in zip(found, joined(ids, v))], pa.bool_()),
            pa.array([hashlib.sha256(x.astype("<i4", copy=False)).hexdigest() for x in ids], pa.string()),
        ]
        if with_ids:
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))))
        return pa.RecordBatch.from_arrays(columns, names=names)

    fields = [
        docs.select(key).schema[0],
        T.StructField("sample", T.IntegerType()),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("log_prob", T.DoubleType()),
        T.StructField("perturbed", T.DoubleType()),
        T.StructField("inclusion", T.DoubleType()),
        T.StructField("round_trip", T.BooleanType()),
        T.StructField("ids_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]
    return docs.select(key, text, F.xxhash64(key).alias("_seed")).mapInArrow(run, T.StructType(fields))
