"""Training-corpus pipeline: quality rules, near-duplicates, benchmark leaks, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written and read again before the next stage, which cuts the lineage. All but
the last return the columns of the documents, whatever other columns there are.

Defined results: documents with a null or empty text, or whose lines all fail,
are rejected by the quality rules; of rows that repeat an id and a text one
stays, rows that repeat an id with other texts are documents of their own;
documents without an id are never near-duplicates, but leave with their leaks
like all others; a document is dropped for a leak only by a benchmark item of
13 tokens or more, or if it is a shorter item's text and nothing else; texts of
any length are taken whole; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from emporia.llm import bpe, decontaminate, ngram_join, pii, quality_rules
from emporia.plans.session import ensure_checkpoint_dir

NEAR = ngram_join.Similarity(n=5, percent=80)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that the rules reject go."""
    return quality_rules.clean(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays."""
    return ngram_join.keep_one(docs, NEAR)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced."""
    return pii.sanitize(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with the text that the ids decode to."""
    return bpe.encode_decode(docs, bpe.default_path())


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("pii", hide_personal_data),
    ("bpe", token_ids),
]

# Hashed similarity over all pairs, corpus co-occurrence and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            out.write.parquet(f"{base}/{k}-{name}")
            out = spark.read.parquet(f"{base}/{k}-{name}")
        docs = out
    return docs
