from __future__ import annotations

import random

import pytest

from forktide.llm import ngram_join as nj
from forktide.llm.components import components
from tests.llm.conftest import prose


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").split() or [""]
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    return out


def brute(texts):
    sets = sets_of(texts)
    links, up = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return links, [find(i) for i in range(len(texts))]


def edited(text: str, seed: int, n: int) -> str:
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{seed}"
    return " ".join(words)


@pytest.mark.parametrize("small,block,few", [(24, 1_024, 500_000), (2, 4, 0)])
def test_classes_and_links_agree_with_brute_force(documents, monkeypatch, small, block, few):
    monkeypatch.setattr(nj, "SMALL", small)
    monkeypatch.setattr(nj, "BLOCK", block)
    monkeypatch.setattr(nj, "BROADCAST_ROWS", few)
    base, other = prose(1, 220), prose(2, 120)
    texts = [base] * 3 + [edited(base, s, 1 + s % 6) for s in range(20)] + [other, edited(other, 5, 2), edited(other, 6, 9)]
    texts += ["", None, "a b", "a b", "a  b", "one two three four five six", prose(3, 50)]
    links, classes = brute(texts)
    docs = documents(texts).selectExpr("*", "1 as class_id")
    rows = {r["doc_id"]: r for r in nj.links(docs).collect()}
    assert [rows[i]["n_links"] for i in range(len(texts))] == links
    assert [rows[i]["class_id"] for i in range(len(texts))] == classes
    kept = sorted(r["doc_id"] for r in nj.keep_one(docs).collect())
    assert kept == sorted(set(classes))


def test_repeated_rows_null_keys_and_empty_table(documents):
    docs = documents(["x y z", "x y z", "p q", None], keys=[1, 1, None, None])
    assert sorted(r["n_links"] for r in nj.links(docs).collect()) == [0, 0, 1, 1]
    kept = nj.keep_one(docs).collect()
    assert len(kept) == 3 and {r["text"] for r in kept} == {"x y z", "p q", None}
    assert nj.links(docs.limit(0)).count() == 0
    assert nj.keep_one(docs.limit(0)).count() == 0


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.9995):
        bands = nj.bands_for(0.8, recall, 5)
        assert 1 - (1 - 0.8**5) ** bands >= recall > 1 - (1 - 0.8**5) ** (bands - 1)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z", f"s{i}") for i in range(40)] + [("q", "q")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {got[f"s{i}"] for i in range(40)} | {got["z"]} == {"s0"}


def test_keeping_one_shuffles_texts_once(spark, documents, monkeypatch):
    docs = documents(["x y z", "p q"])
    found = docs.selectExpr("doc_id", "xxhash64(text) as _row", "text as _class")
    monkeypatch.setattr(nj, "links", lambda *_: found)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = nj.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3  # classes, kept rows, texts
