"""The queries of this subpackage, each over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import dedup, html, ngram, packing, pii, quality, repeats, runs, sampling, sharding, topk, toxicity, variants
from comanda.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and the decision list's verdict of every document."""
    judged, _ = quality.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document by the n-grams of all documents."""
    found = ngram.scores(table(spark, sf_dir, "documents"))
    return found.withColumn("log_score", F.round("log_score", 4))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every row whose vec_id is divisible by 50, by integer inner product."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 50 = 0", 5)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document into shards 0 to 39 by a bounded-load ring; row counts at most one apart."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near-duplicates and whether it is kept."""
    found = dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op7_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two different sampled segmentations of every document, as digests."""
    return sampling.segmentations(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), 2, with_ids=False)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of every document by its nearest labelled examples."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "nearest")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and all spans of personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    return pii.digests(docs, pii.fit(docs))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents' vocabulary with its near words, its form and the last form of its chain."""
    return variants.document_groups(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, as digests."""
    return runs.digests(table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 50 words that an earlier document has."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_lm_scoring,
        op3_html_extraction,
        op4_topk,
        op5_sharding,
        op6_minhash,
        op7_segmentations,
        op8_toxicity,
        op9_pii,
        op10_packing,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_substring_dedup,
    )
}

SQL: dict[str, str] = {
    "op2_lm_scoring": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (
  SELECT doc_id, i, w, lag(w, 1) OVER (PARTITION BY doc_id ORDER BY i) AS w1, lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS w2 FROM p
),
t AS (SELECT count(*) AS n FROM g),
c1 AS (SELECT w, count(*) AS c FROM g GROUP BY w),
c2 AS (SELECT w1, w, count(*) AS c FROM g WHERE w1 IS NOT NULL GROUP BY w1, w HAVING count(*) >= 2),
c3 AS (SELECT w2, w1, w, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY w2, w1, w HAVING count(*) >= 2),
s AS (
  SELECT g.doc_id,
    CASE WHEN c3.c IS NOT NULL THEN 3 WHEN c2.c IS NOT NULL THEN 2 ELSE 1 END AS n,
    CASE WHEN c3.c IS NOT NULL THEN ln(c3.c / b.c)
      WHEN c2.c IS NOT NULL THEN ln(c2.c / a.c) + (least(g.i - 1, 2) - 1) * ln(0.4)
      ELSE ln(c1.c / t.n) + least(g.i - 1, 2) * ln(0.4) END AS x
  FROM g CROSS JOIN t JOIN c1 ON c1.w = g.w
  LEFT JOIN c3 ON c3.w2 = g.w2 AND c3.w1 = g.w1 AND c3.w = g.w
  LEFT JOIN c2 ON c2.w1 = g.w1 AND c2.w = g.w
  LEFT JOIN c2 b ON b.w1 = g.w2 AND b.w = g.w1
  LEFT JOIN c1 a ON a.w = g.w1
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(count(x) FILTER (n = 1) AS BIGINT) AS n_by_1, CAST(count(x) FILTER (n = 2) AS BIGINT) AS n_by_2, CAST(count(x) FILTER (n = 3) AS BIGINT) AS n_by_3,
  round(coalesce(sum(x), 0), 4) AS log_score
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id, ws""",
    "op4_topk": """
WITH v AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS u, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding])
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.u <> q.u
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op13_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM d WHERE len(ws) >= 50),
x AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS s FROM p),
m AS (SELECT s, min(doc_id) AS first FROM x GROUP BY s HAVING count(*) > 1),
g AS (SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 50)) AS j FROM x JOIN m ON m.s = x.s WHERE m.first < x.doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
k AS (
  SELECT w.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY w.j) AS kept FROM w LEFT JOIN g ON g.doc_id = w.doc_id AND g.j = w.j
  WHERE g.j IS NULL GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
}
