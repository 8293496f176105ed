from __future__ import annotations

import random
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from forktide.llm import merkle, queries
from forktide.llm.common import crc_mod


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def hashed_leaf(row, more: int = 0) -> str:
    doc_id, text, lang, source, n_chars = row
    if n_chars is not None:
        n_chars += more
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def reduced(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[bool, str | None]]:
    out = []
    for level in levels[:-1]:
        run = level[at & ~1 : (at & ~1) + 2]
        out.append((at & 1 == 1, run[1 - (at & 1)] if len(run) == 2 else None))
        at >>= 1
    return out


def brute(rows) -> list[tuple]:
    """Results in the order of the groups and leaves, by one sequential walk."""
    from zlib import crc32

    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, hashed_leaf(r)))
        trees.append(reduced([hashed_leaf(r) for r in groups[g]]))
    over = reduced([t[-1][0] for t in trees])
    root, out = over[-1][0], []
    for k, g in enumerate(order):
        for at, row in enumerate(groups[g]):
            steps = path(trees[k], at) + path(over, k)
            bad = row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0
            node = hashed_leaf(row, int(bad))
            for left, other in steps:
                node = h(node) if other is None else h(other, node) if left else h(node, other)
            proof = [other for _, other in steps if other is not None]
            out.append((row[0], trees[k][0][at], trees[k][-1][0], root, h(*proof), node, node == root, tuple(proof)))
    return out


def applied(docs, bits):
    larger = (F.col("n_chars").cast("decimal(20,0)") + crc_mod("doc_id", 7).eqNullSafe(0).cast("int")).cast("decimal(20,0)")
    found = merkle.manifest(docs, tampered={"n_chars": larger}, with_proof=True, bits=bits)
    return [(*r[:-1], tuple(r[-1])) for r in found.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize(("sizes", "bits"), [((1, 2, 3, 5, 16, 17, 70), 2), ((9,), 1), ((1,), 2), ((33, 33), 10)])
def test_equals_a_sequential_walk(documents, sizes, bits):
    r = random.Random(len(sizes))
    texts, langs = [], []
    for k, n in enumerate(sizes):
        texts += [r.choice(["", None, "á", "word " * r.randint(0, 50)]) for _ in range(n)]
        langs += [[None, "", "de", "en", "fr", "é", "zz"][k]] * n
    keys = [None if r.random() < 0.1 else r.randint(-5, 3 * len(texts)) for _ in texts]
    docs = documents(texts, langs, keys)
    rows = [tuple(x) for x in docs.collect()]
    assert ordered(applied(docs, bits)) == ordered(brute(rows))


def test_repeated_rows_clashing_names_and_large_sizes(documents):
    docs = documents(["same"] * 40 + ["x", None], ["en"] * 42, [7] * 40 + [0, 14])
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") == 0, F.lit(2**63 - 1)).otherwise(F.col("n_chars")))
    rows = [tuple(x) for x in docs.collect()]
    clash = docs.selectExpr("*", "1 as g", "2 as i", "3 as k", "4 as h", "5 as n", "6 as b", "7 as salt", "8 as leaf")
    assert ordered(applied(clash, 3)) == ordered(brute(rows))


def test_empty(documents):
    assert applied(documents([]), 2) == []


def test_query_equals_its_sql(spark, sf_dir):
    found = queries.QUERIES["op13_merkle"](spark, sf_dir)
    documents = duckdb.read_parquet(f"{sf_dir}/documents.parquet")  # noqa: F841
    wanted = duckdb.sql(queries.ORACLES["op13_merkle"])
    assert found.columns == wanted.columns
    assert ordered(map(tuple, found.collect())) == ordered(wanted.fetchall())
