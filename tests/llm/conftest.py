from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = {
    "en": "th er on an in ti es or re ed the and of to".split(),
    "de": "sch ein ich und der die zu ge be ver ung keit".split(),
}


def prose(seed: int, words: int, lang: str = "en") -> str:
    r = random.Random(seed)
    parts = SYLLABLES[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of texts, with keys from 0."""

    def make(texts, langs=None, keys=None):
        keys = list(range(len(texts))) if keys is None else keys
        langs = langs or ["en"] * len(texts)
        rows = [(k, t, l, "s", None if t is None else len(t)) for k, t, l in zip(keys, texts, langs)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
