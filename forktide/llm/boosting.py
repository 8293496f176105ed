"""Gradient boosted trees over counted cells of small integer features, as DataFrame expressions.

Examples with equal features are one cell with a count and a number of positives, so the input of the
training is bounded by the number of cells, however many examples there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    limit: int  # left: feature <= limit
    left: Leaf | Split
    right: Leaf | Split


@dataclass
class Trees:
    base: float
    trees: list[Leaf | Split] = field(default_factory=list)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float, ridge: float) -> Leaf | Split:
    """A tree for gradients ``g`` and curvatures ``h``, by the usual second-order gain."""
    total_g, total_h = g.sum(), h.sum()
    best, at = 1e-6, None
    if depth:
        for f in range(x.shape[1]):
            n = int(x[:, f].max()) + 1
            left_g = np.cumsum(np.bincount(x[:, f], weights=g, minlength=n))[:-1]
            left_h = np.cumsum(np.bincount(x[:, f], weights=h, minlength=n))[:-1]
            if not len(left_g):
                continue
            right_g, right_h = total_g - left_g, total_h - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - total_g**2 / (total_h + ridge)
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], (f, k)
    if at is None:
        return Leaf(float(-rate * total_g / (total_h + ridge)))
    side = x[:, at[0]] <= at[1]
    return Split(
        at[0], at[1],
        _grow(x[side], g[side], h[side], depth - 1, rate, ridge),
        _grow(x[~side], g[~side], h[~side], depth - 1, rate, ridge),
    )


def _apply(tree: Leaf | Split, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, Leaf):
        return np.full(len(x), tree.value)
    return np.where(x[:, tree.feature] <= tree.limit, _apply(tree.left, x), _apply(tree.right, x))


def fit(
    x: np.ndarray, count: np.ndarray, positive: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.3,
    ridge: float = 1.0,
) -> Trees:
    """Boosted trees for cells ``x`` (integers from 0) with ``positive`` of ``count`` examples each."""
    share = (positive.sum() + 1) / (count.sum() + 2)
    out = Trees(float(np.log(share / (1 - share))))
    z = np.full(len(x), out.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        tree = _grow(x, count * p - positive, count * p * (1 - p), depth, rate, ridge)
        out.trees.append(tree)
        z += _apply(tree, x)
    return out


def probabilities(model: Trees, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(model.base + sum(_apply(t, x) for t in model.trees))))


def expression(model: Trees, features: list[Column]) -> Column:
    """The probability as a column."""

    def node(tree: Leaf | Split) -> Column:
        if isinstance(tree, Leaf):
            return F.lit(tree.value)
        return F.when(features[tree.feature] <= tree.limit, node(tree.left)).otherwise(node(tree.right))

    z = F.lit(model.base)
    for tree in model.trees:
        z = z + node(tree)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
