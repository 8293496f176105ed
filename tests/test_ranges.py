from __future__ import annotations

import random

import pytest

from forktide.operators import ranges


@pytest.fixture(scope="module")
def rows():
    """One key holds most rows; orders have gaps and values are not monotone."""
    rng = random.Random(3)
    out = []
    for key, n in (("hot", 400), ("small", 25), ("one", 1)):
        order = 0
        for _ in range(n):
            order += rng.choice([1, 1, 1, 2, 9, 60])
            out.append((key, order, rng.randint(0, 1000)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, o bigint, v bigint").repartition(5)


def by_key(rows):
    keys = {}
    for k, o, v in sorted(rows):
        keys.setdefault(k, []).append((o, v))
    return keys


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 16])
def test_running_max_before(spark, rows, width):
    got = ranges.running_max_before(frame(spark, rows), ["k"], "o", "v", "m", width).collect()
    want = {}
    for k, seq in by_key(rows).items():
        best = None
        for o, v in seq:
            want[k, o] = best
            best = v if best is None else max(best, v)
    assert {(r["k"], r["o"]): r["m"] for r in got} == want


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 16])
def test_previous_value(spark, rows, width):
    got = ranges.previous_value(frame(spark, rows), ["k"], "o", "v", "p", width).collect()
    want = {}
    for k, seq in by_key(rows).items():
        before = None
        for o, v in seq:
            want[k, o], before = before, v
    assert {(r["k"], r["o"]): r["p"] for r in got} == want


@pytest.mark.parametrize("width", [7, 1 << 16])
def test_row_numbers(spark, rows, width):
    got = ranges.row_numbers(frame(spark, rows), ["k"], "o", "n", width).collect()
    want = {(k, o): i + 1 for k, seq in by_key(rows).items() for i, (o, _) in enumerate(seq)}
    assert {(r["k"], r["o"]): r["n"] for r in got} == want


@pytest.mark.parametrize(("width", "size"), [(10, 10), (16, 5), (1 << 16, 100)])
def test_trailing_sums(spark, rows, width, size):
    got = ranges.trailing_sums(
        frame(spark, rows), ["k"], "o", "v", size, "s", "n", width
    ).collect()
    want = {}
    for k, seq in by_key(rows).items():
        for i, (o, _) in enumerate(seq):
            last = [v for _, v in seq[max(0, i - size + 1) : i + 1]]
            want[k, o] = (sum(last), len(last))
    assert {(r["k"], r["o"]): (r["s"], r["n"]) for r in got} == want
    assert len(got) == len(rows)


def test_trailing_sums_needs_wide_slices(spark, rows):
    with pytest.raises(ValueError):
        ranges.trailing_sums(frame(spark, rows), ["k"], "o", "v", 100, "s", "n", 50)


def test_sparse_orders_have_few_ranges(spark):
    rows = [(k, o * 1_000_003 + o % 7, o) for k in ("a", "b") for o in range(400 if k == "a" else 3)]
    df = frame(spark, rows)
    got = {(r["k"], r["o"]): r["n"] for r in ranges.row_numbers(df, ["k"], "o", "n", 50, sparse=True).collect()}
    assert got == {(k, o): i + 1 for k, o, i in rows}
    spaced = ranges._spaced(df, ["k"], "o", 50).groupBy("k", "_range").count().collect()
    assert len(spaced) <= 400 // 50 + 2 and max(r["count"] for r in spaced) <= 60
