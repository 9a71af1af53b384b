"""Corpus pipeline: language ID, quality rules, line dedup, n-gram Jaccard join, packing.

``run(spark, sf_dir)`` applies :data:`STAGES` to ``documents``; each stage's result is
written as Parquet to the shared folder and read again as the next one's input. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import lang_id, line_dedup, ngram_join, packing, quality
from tessera.llm.catalog import CAPACITY, TOKENIZER
from tessera.llm.common import documents, materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts."""
    return lang_id.accept(docs, lang_id.train(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, trained on the table ``labels``."""
    return quality.keep(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of an earlier document; emptied documents go."""
    return line_dedup.clean_documents(docs, passage=line_dedup.PASSAGE)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, 0.8 or more)."""
    return ngram_join.keep_one(docs, 5, 80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset. Executors still hold what the join grew to, so
    the encoder's cache is a small one."""
    return packing.pack(docs, TOKENIZER, CAPACITY, cache_bytes=6 << 20)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("best-fit packing", best_fit_packing),
]

#: Models, tokenizer and alignment have no form in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
