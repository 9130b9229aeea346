"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    bpe, collocations, decontaminate, lm_scoring, merkle, ngram_join, pii, quality_rules, radix_dedup, sharding, substring_dedup,
    url_filter, warc,
)
from emporia.plans.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHARDS = sharding.Tree.even(regions=2, racks=3, shards=4)
URL_RULES = [url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
             url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
             url_filter.Rule("com", "/de/", "block")]
# Pages that hold one of these words are reported; their URLs make up the block list.
REPORTED_WORDS = r"\b(stupid|worthless|trash)\b"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), bpe.default_path(),
                             ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality; background: all documents."""
    good = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.score(_table(spark, sf_dir, "documents"), good)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.captures(warc.assemble(warc.read(spark, path, payloads=False)))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans",
                        "n_term")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    url = F.col("url").cast("string")
    listed = (pages.filter(F.col("html").rlike(REPORTED_WORDS))
              .select(F.concat(url_filter.url_host(url), url_filter.url_path(url)).alias("key")))
    return url_filter.judge(pages, listed, URL_RULES)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), SHARDS)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op12_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = radix_dedup.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose ids the rule picks claim the leaf of their text in lower case; a leaf is verified on its own path."""
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.translate("text", UPPER, UPPER.lower()) if c == "text" else F.col(c) for c in fields]
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claimed = docs.withColumn("_claimed", F.when(picked, merkle.leaf_hash(*tampered)))
    found = merkle.build(claimed, fields, carry=["_claimed"]).paths()
    found = found.withColumn("folded_root", merkle.fold(F.coalesce("_claimed", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def _url_filter_sql() -> str:
    """The URL filter as DuckDB SQL over ``pages``; rules in falling length, so the first that fits is the longest."""
    rules = sorted(URL_RULES, key=lambda r: -len(r.text))
    fits = {r.text: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in rules}
    text = " ".join(f"WHEN {fits[r.text]} THEN '{r.text}'" for r in rules)
    verdict = " ".join(f"WHEN {fits[r.text]} THEN '{r.verdict}'" for r in rules)
    upper, lower = UPPER, UPPER.lower()
    return f"""
WITH parts AS (
  SELECT page_id, html,
         translate(COALESCE(regexp_extract(url, '://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
         COALESCE(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
blocked AS (
  SELECT DISTINCT host || path AS key FROM parts WHERE regexp_matches(html, '{REPORTED_WORDS}') AND host || path <> '')
SELECT page_id, host, path, CASE {text} END AS rule,
       CASE {verdict} WHEN key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, key IS NOT NULL AS listed
FROM parts LEFT JOIN blocked ON host || path = key"""


def oracle_sql() -> dict[str, str]:
    """SQL twins; the other operators are beyond SQL, or too slow in it over whole tables, and have plain twins in the tests."""
    return {"op7_url_filter": _url_filter_sql()}
