from __future__ import annotations

import random
import re

import numpy as np

from forktide.llm import boosting, pii

# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = [
    "a", "b9", "@", ".", "..", "-", "_", "%", "+", "1", "23", "255", "256", "0", "007", " ", "  ", "(", ")", "é",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "1.2.3.4", "+1 (555) 555-0100", "\n", "x@y.z", "999", "😀", ",",
]


def passes(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        return 16 <= len(digits) <= 19 and odd % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    found = ((k, m) for k in PATTERNS for m in re.finditer(PATTERNS[k], text or ""))
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found if passes(k, m[0]))


def test_base_spans_agree_with_the_patterns(documents):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(1_500)]
    texts += [None, "", "1 " * 3_000, "a@b" + ".c" * 3_000, "9" * 20_000, ".".join("1" * 2_000), "1.2.3.4 " * 700]
    docs = documents(texts).selectExpr("*", "1 as spans")
    rows = {r["doc_id"]: r["b"] for r in pii.find(docs).select("doc_id", pii.written("base").alias("b")).collect()}
    assert [rows[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_near_misses_are_added_when_they_look_like_hits(documents):
    r = random.Random(2)
    good = [f"call +1 (555) {r.randint(200, 999)}-{r.randint(1000, 9999)} now" for _ in range(800)]
    texts = [*good, "call (555) 234-5678 now", "nothing"]
    found = pii.proposals(documents(texts))
    model = pii.learn(found)
    assert model.trees is not None
    rows = {r["_key"]: r for r in pii.select(found, model).collect()}
    assert all(len(rows[i]["spans"]) >= 1 for i in range(800))
    assert rows[801]["spans"] == []
    assert all(set(r["base"]) <= set(r["spans"]) for r in rows.values())


def test_other_forms_beside_telling_words_are_added_and_false_ones_are_not(documents):
    r = random.Random(3)
    texts = []
    for i in range(600):
        phone = f"{r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"
        texts += [f"call +1 ({phone} now", f"mail n{i}@h{i % 9}.org now", f"row +1 ({phone} end", f"row n{i}@h{i % 9}.org end"]
        if i % 3 == 0:
            texts += [f"call ({phone} now", f"mail n{i} (at) h{i % 9} (dot) org now", f"row ({phone} end"]
            texts += [f"card 4111 1111 1111 {1112 + i % 9} now"] * 2 + ["card 4111 1111 1111 1111 now"] * 2
    rows = ["call (555) 234-5678 now", "mail name (at) host (dot) com. Then", "part (555) 234-5678 now", "card 4111 1111 1111 1112 now"]
    docs = documents(texts + rows)
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).filter(f"doc_id >= {len(texts)}").collect()}
    assert [got[len(texts) + i] for i in range(4)] == ["call [PHONE] now", "mail [EMAIL]. Then", *rows[2:]]


def test_redaction_keeps_rows_and_columns(documents):
    texts = ["mail x@y.org, ip 10.0.0.1!", "clean text 12", None, "", "+1 (555) 555-0100", "+1 (555) 555-0100"]
    docs = documents(texts, keys=[1, 2, 3, None, 5, 5]).selectExpr("*", "'k' as _spans2", "7 as spans")
    rows = pii.redact(docs).collect()
    assert len(rows) == 6 and rows[0].__fields__ == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in rows)
    assert (1, "mail [EMAIL], ip [IP]!") in got and (2, "clean text 12") in got
    assert got.count((5, "[PHONE]")) == 2 and (3, None) in got and (0, "") in got
    assert pii.redact(docs.limit(0)).count() == 0 and pii.find(docs.limit(0)).count() == 0


def test_boosted_trees_as_expression_and_arrays(spark):
    r = np.random.default_rng(1)
    x = r.integers(0, 5, (200, 3))
    n = r.integers(1, 9, 200).astype(float)
    y = n * ((x[:, 0] > 2) ^ (x[:, 1] == 1))
    model = boosting.fit(x, n, y)
    p = boosting.probabilities(model, x)
    assert ((p > 0.5) == (y > 0)).mean() > 0.97
    df = spark.createDataFrame([(i, *map(int, v)) for i, v in enumerate(x)], "i int, a int, b int, c int")
    from pyspark.sql import functions as F

    got = {r["i"]: r["p"] for r in df.select("i", boosting.expression(model, [F.col(c) for c in "abc"]).alias("p")).collect()}
    assert np.allclose([got[i] for i in range(200)], p)
