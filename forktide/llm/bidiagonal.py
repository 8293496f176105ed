"""Singular values and right singular vectors of a small square matrix, by its bidiagonal form.

Householder reflections make the matrix bidiagonal; dqds (differential quotient-difference steps with
shifts, which only add, multiply and divide positive numbers) finds the squared singular values to high
relative accuracy; a vector comes from the twisted factorisation of the shifted product at the place
where its residual is least. All arrays here have the size of one dimension squared.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TOO_CLOSE = 1e-6  # relative distance of squared singular values below which vectors are found together


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, upper diagonal b and orthogonal v with ``matrix = u @ bidiagonal(a, b) @ v.T``."""
    m = np.array(matrix, float)
    d = len(m)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """Unit w for which x - 2 w (w . x) has only its first entry."""
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.abs(x[1:]).max(initial=0.0):
            return None
        w = x / size
        w[0] += np.copysign(np.sqrt(w @ w), w[0])
        return w / np.sqrt(w @ w)

    for k in range(d):
        w = reflector(m[k:, k])
        if w is not None:
            m[k:, k:] -= np.outer(2 * w, w @ m[k:, k:])
        if k + 2 < d:
            w = reflector(m[k, k + 1 :])
            if w is not None:
                m[k:, k + 1 :] -= np.outer(m[k:, k + 1 :] @ w, 2 * w)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    return m.diagonal().copy(), m.diagonal(1).copy(), v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step; None if the shift exceeds the smallest value."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    if d < 0:
        return None
    for k in range(n - 1):
        s = new_q[k] = d + e[k]
        if s == 0.0:
            # Nothing couples k and k + 1.
            d = q[k + 1] - shift
        else:
            t = q[k + 1] / s
            new_e[k] = e[k] * t
            d = d * t - shift
        if d < 0 or d != d:
            return None
    new_q[-1] = d
    return new_q, new_e


def _guess(q: list[float], e: list[float]) -> float:
    """The smaller value of the last two rows, a little reduced."""
    a, b, c = q[-2], e[-1], q[-1]
    half = (a + b + c) / 2
    root = np.sqrt(max(half * half - a * c, 0.0))
    low = a * c / (half + root) if half + root > 0 else 0.0
    return low * (1 - 8 * EPS)


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of the bidiagonal matrix (a, b), falling."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return [0.0] * len(a)
    found: list[float] = []
    todo = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    small = (16 * EPS) ** 2
    while todo:
        q, e, base = todo.pop()
        while True:
            n = len(q)
            if n == 1:
                found.append(base + q[0])
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= small * (base + min(q[k], q[k + 1])) or e[k] < 1e-290), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]  # the flipped matrix has the same values; small ones go to the end
            shift = _guess(q, e)
            for factor in (1.0, 0.9, 0.5, 0.1, 0.0):
                done = _step(q, e, factor * shift)
                if done is not None:
                    (q, e), base = done, base + factor * shift
                    break
    return sorted((x * scale * scale for x in found), reverse=True)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z with B'B z = value z, for a bidiagonal B without zeros on its upper diagonal."""
    n = len(a)
    tiny = EPS * EPS * max(value, float((a * a).max()), float((b * b).max(initial=0.0)), 1e-300)
    q, e, ab = (a * a).tolist(), (b * b).tolist(), (a[:-1] * b).tolist()

    def divisor(x: float) -> float:
        return x if abs(x) > tiny else (-tiny if x < 0 else tiny)

    s, low = [-value], [0.0] * (n - 1)
    for i in range(n - 1):
        t = divisor(s[i] + q[i])
        low[i] = ab[i] / t
        s.append(s[i] * e[i] / t - value)
    p, up = [0.0] * n, [0.0] * (n - 1)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        t = divisor(e[i] + p[i + 1])
        up[i] = ab[i] / t
        p[i] = p[i + 1] * q[i] / t - value
    residual = [abs(x + y + value) for x, y in zip(s, p)]
    r = residual.index(min(residual))
    z = [0.0] * n
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    out = np.array(z)
    out /= np.abs(out).max()
    return out / np.sqrt(out @ out)


def _together(a: np.ndarray, b: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """Orthonormal vectors of values that are too close to tell apart: inverse iteration, each vector
    kept orthogonal to those before it."""
    n = len(a)
    product = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    product[np.arange(1, n), np.arange(1, n)] += b * b
    size = np.abs(product).max()
    found: list[np.ndarray] = []
    for k, value in enumerate(values):
        z = np.cos(np.arange(1, n + 1) * (k + 1.0))
        shifted = product - (value + (k + 1) * 4 * EPS * size) * np.eye(n)
        for _ in range(5):
            z = np.linalg.solve(shifted, z)
            z /= np.abs(z).max()
            for _ in range(2):
                for other in found:
                    z = z - (other @ z) * other
            z /= np.sqrt(z @ z)
        found.append(z)
    return found


def right_singular(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``most`` squared singular values, and their unit right vectors as columns."""
    size = float(np.abs(matrix).max(initial=0.0)) or 1.0
    a, b, v = bidiagonalise(np.asarray(matrix, float) / size)
    d = len(a)
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))) + 1).tolist(), d]
    pairs: list[tuple[float, int, int, int]] = []
    by_block: dict[int, list[float]] = {}
    for lo, hi in zip(cuts, cuts[1:]):
        by_block[lo] = squared_singular_values(a[lo:hi], b[lo : hi - 1])
        pairs += [(value, -lo, hi, place) for place, value in enumerate(by_block[lo])]
    pairs.sort(key=lambda x: (-x[0], -x[1], x[3]))
    columns: list[np.ndarray] = []
    close: dict[tuple[int, int], list[np.ndarray]] = {}
    for value, lo, hi, place in pairs[:most]:
        lo, values = -lo, by_block[-lo]
        first = last = place
        while first > 0 and values[first - 1] - values[first] <= TOO_CLOSE * values[0]:
            first -= 1
        while last + 1 < len(values) and values[last] - values[last + 1] <= TOO_CLOSE * values[0]:
            last += 1
        z = np.zeros(d)
        if first == last:
            z[lo:hi] = twisted_vector(a[lo:hi], b[lo : hi - 1], value)
        else:
            if (lo, first) not in close:
                close[lo, first] = _together(a[lo:hi], b[lo : hi - 1], values[first : last + 1])
            z[lo:hi] = close[lo, first][place - first]
        z = v @ z
        columns.append(z * np.sign(z[np.abs(z).argmax()]))
    return np.array([x[0] for x in pairs[:most]]) * size * size, np.array(columns).reshape(-1, d).T
