"""Stages keep all columns of their input, whatever they are called."""

from __future__ import annotations

from forktide.llm import decontamination, ngram_join, pii
from forktide.llm.common import free_names
from tests.llm.conftest import prose

NAMES = "_k _r _spans _own _own0 _OWN1 _own2 _own3 _leaked _kept _kept_row _row _key _hits spans base item_id node root".split()


def crowded(docs):
    return docs.selectExpr("*", *[f"'{n}' as `{n}`" for n in NAMES])


def same_but_text(before, after, gone=()):
    old = {r["doc_id"]: r for r in before.collect() if r["doc_id"] not in gone}
    new = {r["doc_id"]: r for r in after.collect()}
    assert after.columns == before.columns and set(old) == set(new)
    assert all(all(r[n] == n for n in NAMES) for r in new.values())
    return new


def test_redact(documents):
    docs = crowded(documents(["write to ann@example.org now", "nothing here", None]))
    assert same_but_text(docs, pii.redact(docs))[0]["text"] == "write to [EMAIL] now"


def test_clean(documents, spark):
    passage = prose(1, 40)
    docs = crowded(documents([prose(2, 30) + " " + passage, prose(3, 60), None]))
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    same_but_text(docs, decontamination.clean(docs, items, by_share=True), gone={0})


def test_keep_one(documents):
    docs = crowded(documents([prose(1, 50), prose(2, 50), prose(1, 50)]))
    same_but_text(docs, ngram_join.keep_one(docs), gone={2})


def test_free_names(documents):
    assert free_names(crowded(documents([])), n=2) == ["_own4", "_own5"]
