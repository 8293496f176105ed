from __future__ import annotations

import corpus_pipeline
from forktide.llm.queries import QUERIES
from tests.llm.conftest import prose


def test_stages_on_planted_cases(spark, documents, tmp_path):
    item = prose(900, 30)
    texts = [prose(i, 80, "de" if i % 2 else "en") for i in range(30)]
    texts += [texts[0], texts[1] + " end", f"{prose(70, 20)} {item}", "my ip is 10.0.0.7 " + prose(71, 40), "12 34", None]
    docs = documents(texts, ["de" if i % 2 else "en" for i in range(30)] + ["en"] * 6)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        left.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    assert left[0] == set(range(34))
    assert left[1] == left[0] - {30, 31}
    assert left[2] == left[1] - {32}
    assert left[3] == left[2]
    changed = {r["doc_id"]: r for r in kept.collect()}
    assert changed[33]["text"].startswith("my ip is [IP] ") and changed[33]["n_chars"] == len(changed[33]["text"])
    assert all(changed[i]["text"] == texts[i] for i in range(30))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == left[3]
    assert out.filter("not round_trip").count() == 0


def test_empty_table(spark, documents, tmp_path):
    documents(["a"]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
