"""The registered queries and the pipeline."""

import corpus_pipeline
import pytest
from llm_brute import by_id, jaccard_components, sha256, window_dedup

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_decontamination": ["doc_id", "item_id"],
    "op3_lm_scoring": ["doc_id", "score"],
    "op4_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op7_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12_radix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}
ROWS_OF_THEIR_OWN = {"op2_decontamination", "op11_collocations"}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    out = entry.queries()[name](spark, SF)
    assert [c for c in out.columns if c in COLUMNS[name]] == COLUMNS[name]
    table = "pages" if name in ("op4_warc", "op7_url_filter") else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert out.count() == n if name not in ROWS_OF_THEIR_OWN else out.count() > 0


def test_contract_digests(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = entry.queries()["op8_substring_dedup"](spark, SF).collect()
    assert by_id(map(tuple, got)) == by_id(window_dedup(rows))
    got = entry.queries()["op6_ngram_jaccard_join"](spark, SF).collect()
    assert by_id(map(tuple, got)) == by_id(jaccard_components(rows))
    assert all(r.base_sha256 != "" for r in entry.queries()["op5_pii"](spark, SF).collect())
    assert sha256("") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    assert [x for x, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "decontamination", "pii", "bpe"]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())


def _odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like the stages' own."""
    line = lambda k, n=30: " ".join(f"{k}word{i}" for i in range(n)) + "."
    near = line("n").replace("nword29", "changed")
    leak = " ".join(f"bench{i}" for i in range(20))
    rows = [(1, line("a")), (1, line("a")), (1, line("b")), (2, line("a")), (3, line("n")), (4, near), (None, line("c")), (None, line("c")),
            (5, None), (6, ""), (7, "menu | home | login"), (8, line("d") + " " + leak + " " + line("e")), (9, "write to ann@mail.example " + line("f")),
            (10, " ".join(line(f"l{i}") for i in range(400)))]
    names = ["_key", "_gone", "_leaked", "root", "n_tokens", "mark", "node", "text_", "share"]
    columns = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars int", *[f"{c} string" for c in names]])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *names) for i, t in rows], columns)
    bench = spark.createDataFrame([(1, leak), (2, "no"), (3, None), (None, "x")], "item_id long, text string")
    return docs, bench


def test_pipeline_on_odd_rows(spark, tmp_path):
    docs, bench = _odd_documents(spark)
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        kept[name] = sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is None, i or 0))
    assert kept["quality_rules"] == [1, 1, 1, 2, 3, 4, 8, 9, 10, None, None]
    # One copy of a's text and b's stay, though both have the id 1; 4 is near 3.
    assert kept["ngram_jaccard_join"] == [1, 1, 3, 8, 9, 10, None, None]
    assert kept["decontamination"] == kept["pii"] == kept["bpe"] == [1, 1, 3, 9, 10, None, None]
    assert "ann@mail.example" not in {w for r in spark.read.parquet(str(tmp_path / "pii")).collect() for w in r.text.split()}


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs, bench = _odd_documents(spark)
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
