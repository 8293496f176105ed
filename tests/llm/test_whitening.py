from __future__ import annotations

import math

import numpy as np
import pytest

from forktide.llm import queries
from forktide.llm.bidiagonal import bidiagonalise, right_singular, squared_singular_values, twisted_vector
from forktide.llm.whitening import deviations, learn, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, components=4):
    """Results by one dense covariance, up to the sign of a component."""
    good = [(k, v) for k, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in good], dtype=object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - np.array([s / n for s in sums])).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for (k, _), row in zip(good, x):
        away = n * row - sums
        for c in range(min(components, len(sums))):
            w = float((away / n).astype(float) @ vectors[:, c]) / math.sqrt(values[c])
            out.append((k, c + 1, n, int((away * away).sum()), w, values[c] / values.sum()))
    return out


def check(found, rows, components=4):
    got = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"], abs(r["whitened"])))
    wanted = sorted(brute(rows, components), key=lambda r: (r[0], r[1], abs(r[4])))
    assert [tuple(r)[:4] for r in got] == [r[:4] for r in wanted]
    signs = {}
    for g, w in zip(got, wanted):
        if abs(w[4]) > 1e-6:
            signs.setdefault(w[1], set()).add(np.sign(g["whitened"] * w[4]))
        assert abs(abs(g["whitened"]) - abs(w[4])) < 1e-8
        assert g["explained"] == pytest.approx(w[5], rel=1e-9)
        assert g["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def vectors(seed, n, d):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, d)) * np.arange(1, d + 1) / 4).astype(np.float32)


def test_equals_a_dense_covariance(spark):
    rows = [(k, v.tolist()) for k, v in enumerate(vectors(1, 300, 7))]
    rows += [(1_000 + k, rows[3][1]) for k in range(200)] + [(5, rows[5][1])] * 3  # a hot vector, repeated rows
    bad = [(2_000, None), (2_001, [float("nan")] + [0.0] * 6), (2_002, [float("inf")] * 7), (2_003, [None] + [0.0] * 6), (2_004, [])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows + bad], SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as k", "4 as component")
    check(whiten(df, learn(df)), rows)


def test_many_blocks(spark):
    rows = [(k, v.tolist()) for k, v in enumerate(vectors(2, 400, 5))]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA).repartition(40)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        check(whiten(df, learn(df)), rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_few_rows_and_dimensions(spark):
    def run(rows):
        df = spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA)
        return sorted(tuple(r) for r in whiten(df, learn(df)).collect())

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    # One distinct vector: no variance.
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [(k, c, 1, 0, None, None, None) for k in (1, 2) for c in (1, 2)]
    # Two points of three dimensions: one direction with variance.
    found = run([(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])][:2])
    assert [r[4] is None for r in found] == [False, True, True] * 2
    assert [abs(r[4]) for r in found if r[4] is not None] == pytest.approx([1.0, 1.0])
    assert [r[5] for r in found[:3]] == pytest.approx([1.0, 0.0, 0.0]) and found[0][3] == 3 * 256 * 256
    # Another length than most, and a key that is NULL.
    rows = [(None, [0.0, 0.5]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0]), (5, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA)
    assert {r["vec_id"] for r in whiten(df, learn(df)).collect()} == {None, 2, 3}


def test_deviations():
    x = np.array([[3, -4], [0, 7]])
    assert deviations(x, 2, (3, 3)) == [9 + 121, 9 + 121]
    huge = np.array([[2**62, 0], [5, 5]])
    assert deviations(huge, 2, (2**62 + 5, 5)) == [None, None]
    far = np.array([[10**9, 0], [0, 0]])
    assert deviations(far, 3, (10**9, 0)) == [4 * 10**18, 10**18]
    assert deviations(np.array([[2**63 - 1]]), 1, (2**63 - 1,)) == [0]
    assert deviations(np.zeros((0, 2), np.int64), 1, (0, 0)) == []


CASES = {
    "random": lambda r: r.normal(size=(20, 20)),
    "graded": lambda r: np.linalg.qr(r.normal(size=(99, 30)) * np.logspace(0, -8, 30), mode="r"),
    "identity": lambda r: np.eye(9),
    "orthogonal": lambda r: np.linalg.qr(r.normal(size=(24, 24)))[0],
    "diagonal": lambda r: np.diag([3.0, 3, 2, 0, 1, 0]),
    "low rank": lambda r: r.normal(size=(20, 3)) @ r.normal(size=(3, 20)),
    "twice": lambda r: np.kron(np.eye(2), r.normal(size=(9, 9))),
    "large": lambda r: r.normal(size=(9, 9)) * 1e150,
    "small": lambda r: r.normal(size=(9, 9)) * 1e-150,
    "zero": lambda r: np.zeros((4, 4)),
    "one": lambda r: np.array([[-2.0]]),
}


@pytest.mark.parametrize("case", CASES)
def test_singular_vectors(case):
    m = CASES[case](np.random.default_rng(7))
    values, v = right_singular(m, len(m))
    size = np.abs(m).max() or 1.0
    wanted = np.linalg.svd(m / size)[1] ** 2
    assert np.abs(values / size / size - wanted).max() <= 1e-12 * max(wanted[0], 1e-300)
    assert np.abs(v.T @ v - np.eye(len(m))).max() < 1e-11
    a = m / size
    assert np.abs(a.T @ a @ v - v * (values / size / size)).max() <= 1e-12 * max(wanted[0], 1)


def test_small_values_are_found_to_full_relative_accuracy():
    # Of a bidiagonal matrix, dqds finds all values, not only the large ones.
    a, b = np.logspace(0, -12, 25), np.logspace(-1, -13, 24)
    exact = np.sqrt(squared_singular_values(a, b))
    # The product of the values is that of the diagonal.
    assert np.log(exact).sum() == pytest.approx(np.log(a).sum(), rel=1e-13)
    turned = np.sqrt(squared_singular_values(a[::-1], b[::-1]))
    assert np.abs(turned / exact - 1).max() < 1e-12


def test_parts_of_the_method():
    m = np.random.default_rng(3).normal(size=(8, 8))
    a, b, v = bidiagonalise(m)
    form = np.diag(a) + np.diag(b, 1)
    assert np.abs(v.T @ m.T @ m @ v - form.T @ form).max() < 1e-12
    value = squared_singular_values(a, b)[0]
    z = twisted_vector(a, b, value)
    assert np.abs(form.T @ form @ z - value * z).max() < 1e-12 * value


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(queries.QUERIES["op11_whitening"](spark, sf_dir), rows)
