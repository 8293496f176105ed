from __future__ import annotations

import hashlib
import re

import pytest

from forktide.llm import fingerprints as fp
from tests.llm.conftest import prose


def shingles(text):
    words = re.split(r"\s+", text.strip(" "))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("rows_each", [3, 2_000])
def test_edited_pairs(documents, monkeypatch, rows_each):
    monkeypatch.setattr(fp, "STRETCH_ROWS", rows_each)
    base = prose(1, 300)
    texts = [base, base, base + " tail", "", None, "a", "é" * 7, prose(2, 40), "x y", "x y", prose(3, 900)]
    keys = [5, 50, 7, 9, 11, 13, 20, 21, 22, 30, 40]
    docs = documents(texts, keys=keys).selectExpr("*", "'z' as fingerprint").repartition(3)
    rows = {r["doc_id"]: r for r in fp.edited_pairs(docs).collect()}
    order = sorted(zip(keys, [t or "" for t in texts]))
    for i, (key, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = rows[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(row["near_edited"] - jaccard(text, edited)) < 0.15
        assert abs(row["near_next"] - jaccard(text, after)) < 0.15
        assert len(row["fingerprint"]) == 2 * fp.BINS
    assert rows[5]["fingerprint"] == rows[50]["fingerprint"] != rows[7]["fingerprint"]
    assert rows[9]["fingerprint"] == rows[11]["fingerprint"]


def test_single_repeated_null_and_no_rows(documents):
    one = fp.edited_pairs(documents(["a b c d e f g"])).collect()[0]
    assert one["near_next"] == 1.0
    rows = fp.edited_pairs(documents(["a b", "c d", "c d", None], keys=[None, 1, 1, None])).collect()
    assert len(rows) == 4
    assert fp.edited_pairs(documents(["a"]).limit(0)).count() == 0
    assert fp.fingerprints(documents(["a", None])).count() == 2


def test_only_the_rows_sent_to_another_stretch_are_hashed_again(documents, monkeypatch):
    """Signatures come after the join that chooses those rows, not below it."""
    monkeypatch.setattr(fp, "STRETCH_ROWS", 3)
    found = fp.edited_pairs(documents([prose(i, 12) for i in range(20)]))
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "xxhash64" in "".join(lines[:at]) and "xxhash64" not in "".join(lines[at:])
