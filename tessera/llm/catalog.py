"""Registered queries of the training-data operators: ``QUERIES[name](spark, sf_dir)``.
None has an oracle in SQL (each needs a model, a tokenizer or an alignment) but for the
exact search; the others are tested against brute-force versions in ``tests/llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import bpe, compression, html_extract, lang_id, line_dedup, ngram_join, packing, quality, ranked, runs, sharding, token_counts, topk
from tessera.llm.common import documents

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 2048
SHARDS = 40
#: An id beyond the vocabulary (49,408 ids) that still fits 16 bits.
SEPARATOR = 49_408


def op1_topk(spark, sf_dir):
    """Five best candidates of every query vector (ids divisible by 50)."""
    vectors = topk.quantise(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk.top_k(vectors, F.col("id") % 50 == 0, 5)


def op2_packing(spark, sf_dir):
    """Best-fit packing of all documents into sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), TOKENIZER, CAPACITY)


def op3_bpe(spark, sf_dir):
    """Encode and decode every document."""
    return bpe.round_trip(documents(spark, sf_dir), TOKENIZER)


def op4_ngram_join(spark, sf_dir):
    """Components of documents whose 3-word shingles have a Jaccard of 0.9 or more."""
    return ngram_join.components(documents(spark, sf_dir), 3, 90)


def op5_language_id(spark, sf_dir):
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    found = lang_id.predict(docs, lang_id.train(docs))
    return found.select("doc_id", lang_id.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op6_quality(spark, sf_dir):
    """Base counts and the verdict on every document."""
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_token_counts(spark, sf_dir):
    """Tokens of every document in flat token files of the corpus."""
    return token_counts.corpus_token_counts(documents(spark, sf_dir), TOKENIZER, SEPARATOR)


def op8_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), html_extract.train())


def op9_line_dedup(spark, sf_dir):
    """Every document without the passages that an earlier one has."""
    return line_dedup.dedup_lines(documents(spark, sf_dir), passage=line_dedup.PASSAGE)


def op10_sharding(spark, sf_dir):
    """Shard and slot of every document, sizes near equal."""
    placed = sharding.assign(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_ranked(spark, sf_dir):
    """Ten highest-scoring documents of every benchmark item."""
    return ranked.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


def op12_compression(spark, sf_dir):
    """Quality of every document by compressed sizes."""
    docs = documents(spark, sf_dir)
    return compression.score(docs, compression.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op13_runs(spark, sf_dir):
    """Periodic runs of every document, by digests."""
    return runs.run_digests(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_topk, op2_packing, op3_bpe, op4_ngram_join, op5_language_id, op6_quality, op7_token_counts, op8_html_extract, op9_line_dedup, op10_sharding, op11_ranked, op12_compression, op13_runs)}

ORACLE = {
    "op1_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_ranked": r"""
WITH item_terms AS (
    SELECT item, item_id, term, count(*) AS c
    FROM (
        SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
    ) GROUP BY ALL
), doc_terms AS (
    SELECT row, doc_id, term, count(*) AS tf
    FROM (
        SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
    ) GROUP BY ALL
), lengths AS (
    SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY row
), corpus AS (
    SELECT CAST(count(*) AS BIGINT) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM lengths
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(N_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM doc_terms, corpus GROUP BY term
), scores AS (
    SELECT item, item_id, row, doc_id,
           CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * N_docs) // L))))) AS BIGINT) AS score
    FROM item_terms JOIN doc_terms USING (term) JOIN weights USING (term) JOIN lengths USING (row), corpus
    GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
