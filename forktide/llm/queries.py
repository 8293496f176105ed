"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.llm import byte_pairs, class_lm, decontamination, fingerprints, html_text, language_id, merkle, ngram_join, pii, piece_sampling, quality, token_counts, whitening
from forktide.llm.common import ORACLES, QUERIES, crc_mod, query, table  # noqa: F401

BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and how much of it fits the limit."""
    counts = token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY), budget=TOKEN_LIMIT
    )
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars"
    )


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose key has crc32 mod 4 other than 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    trees = language_id.learn_from(docs.filter(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"), keep=("url",))
    return found.select("page_id", "url", "text", "n_chars")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned from those whose key has crc32 mod 3 other than 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = crc_mod("doc_id", 3) == 1
    labels = labels.filter(~held_out & F.col("quality").isin(0, 1))
    scored = quality.score(docs, quality.learn_from(labels, docs))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with estimated similarities."""
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that share a passage, words replaced or not."""
    return decontamination.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), by_share=True
    )


@query("op8_ngram_join")
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, at a Jaccard similarity of 0.8 of five-word shingles."""
    found = ngram_join.links(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op3_class_lm")
def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; learned from those whose key has crc32 mod 7 other than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    scored = class_lm.fit_and_score(docs, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


@query("op4_piece_sampling")
def op4_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four distinct sampled segmentations of every document, with inclusion scores."""
    return piece_sampling.segmentations(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY), with_ids=False
    )


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans by kind, and all spans."""
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(kind, "base").alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.written("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.written("spans").alias("spans"))


# Levels of both trees are built by recursion; crc32 is written out by its bits, as a register that starts
# from all ones and takes each byte and then eight shifts (marked -1). Steps are a side and a hash.
MERKLE_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS size,
    coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR)::VARCHAR || ':' || (n_chars::HUGEINT + 1)::VARCHAR, '-') AS other,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS body,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END)) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || size || body) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || other || body) ELSE sha256(head || size || body) END AS seen
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), tree(level, lang, i, n, h) AS (
  SELECT 0, lang, i, n, leaf FROM leaves
  UNION ALL
  SELECT level + 1, lang, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY level, lang, i // 2, n
), subroots AS (
  SELECT level, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1
), over_tree(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM over_tree WHERE n > 1 GROUP BY level, i // 2, n
), tops AS (SELECT level, h FROM over_tree WHERE n = 1),
over_steps AS (
  SELECT s.lang, l.level, CASE WHEN t.h IS NULL THEN '' WHEN (s.i >> l.level) % 2 = 1 THEN '<' || t.h ELSE '>' || t.h END AS step
  FROM subroots s, tops p, unnest(range(p.level)) AS l(level)
  LEFT JOIN over_tree t ON t.level = l.level AND t.i = xor(s.i >> l.level, 1)
), outer_lists AS (
  SELECT lang, list(step ORDER BY level) AS steps FROM over_steps GROUP BY lang
), own_steps AS (
  SELECT d.lang, d.i, l.level, CASE WHEN t.h IS NULL THEN '' WHEN (d.i >> l.level) % 2 = 1 THEN '<' || t.h ELSE '>' || t.h END AS step
  FROM leaves d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang, unnest(range(s.level)) AS l(level)
  LEFT JOIN tree t ON t.level = l.level AND t.lang IS NOT DISTINCT FROM d.lang AND t.i = xor(d.i >> l.level, 1)
), own_lists AS (
  SELECT lang, i, list(step ORDER BY level) AS steps FROM own_steps GROUP BY lang, i
), proven AS (
  SELECT d.doc_id, d.leaf, d.seen, s.h AS subroot, p.h AS root, coalesce(o.steps, []) || coalesce(u.steps, []) AS steps
  FROM leaves d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang, tops p
  LEFT JOIN own_lists o ON o.lang IS NOT DISTINCT FROM d.lang AND o.i = d.i
  LEFT JOIN outer_lists u ON u.lang IS NOT DISTINCT FROM d.lang
), folded AS (
  SELECT *, sha256(coalesce(array_to_string(list_transform(steps, lambda x: x[2:]), ''), '')) AS proof_sha256,
    list_reduce(list_prepend(seen, steps), lambda h, x: CASE WHEN x = '' THEN sha256(h)
      WHEN x[1] = '<' THEN sha256(x[2:] || h) ELSE sha256(h || x[2:]) END) AS folded_root
  FROM proven
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


@query("op13_merkle", MERKLE_SQL)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; every seventh key's size is tampered with."""
    docs = table(spark, sf_dir, "documents")
    # As a decimal, so that adding one to the largest size is no overflow.
    larger = F.col("n_chars").cast("decimal(20,0)") + crc_mod("doc_id", 7).eqNullSafe(0).cast("int")
    return merkle.manifest(docs, tampered={"n_chars": larger.cast("decimal(20,0)")})


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and what they decode to, as hashes."""
    return byte_pairs.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), with_ids=False)


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the four leading directions of the distinct ones."""
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.learn(rows))
