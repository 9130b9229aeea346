"""Collocation mining against a plain version, and the transducers on their own."""

import random

import numpy as np
import pytest
from llm_brute import collocations as plain
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emporia.llm import collocations as C

SF = "/root/testdata/sf0.001"


def mined(spark, rows, spec, parts=5):
    docs = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, words int, phrase string")
    out = C.mine(docs.repartition(parts), spec)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


def prose(seed, count):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "ÉÄ", "x" * 50, "a", "b", "中文", "in", "on", "\x00", "é z"]
    rows = [(None, None), ("en", ""), ("en", " \t\n"), ("und", "a b a b"), ("zz", "rare words here"), ("", "a b " * 50)]
    for i in range(count):
        n = rng.randrange(0, 60)
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! "]) for _ in range(n))
        rows.append((rng.choice(["en", "en", "en", "fr", None]), text + "new york city hall" * (i % 3 == 0)))
    return rows


@pytest.mark.parametrize("shard,span,merge", [(C.SHARD_BYTES, C.RANGE_BYTES, C.MERGE_PATHS), (700, 1500, 300), (60, 400, 50)])
def test_equals_plain_counts(spark, monkeypatch, shard, span, merge):
    monkeypatch.setattr(C, "SHARD_BYTES", shard)
    monkeypatch.setattr(C, "RANGE_BYTES", span)
    rows = prose(shard, 200)
    for spec in (C.Mining(), C.Mining(3, 60, 25)):
        assert mined(spark, rows, spec) == plain(rows, spec.min_count, spec.covered, spec.top)


def test_a_text_longer_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD_BYTES", 100)
    monkeypatch.setattr(C, "RANGE_BYTES", 2000)
    rng = random.Random(1)
    rows = [("en", "".join(rng.choice(["new york ", "of the ", "q" * 90 + " ", "z, "]) for _ in range(900))), ("en", "w" * 5000)]
    assert mined(spark, rows, C.Mining(5, 80, 100)) == plain(rows, 5, 80, 100)


def test_hot_path_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(C, "RANGE_BYTES", 300)
    rows = [("en", "new york city hall")] * 400 + [("en", f"new york w{i} x{i}") for i in range(200)]
    assert mined(spark, rows, C.Mining()) == plain(rows)
    assert mined(spark, [], C.Mining()) == []


def test_transducers_share_states_and_spell_their_paths():
    rng = np.random.default_rng(3)
    rows, counts = C.summed(rng.integers(0, 6, (4000, 4)), np.ones(4000, dtype=np.int64))
    counts = np.minimum(counts, 2)
    layers = C.transducer(rows, counts)
    assert all((a == b).all() for a, b in zip(C.spelled(layers), (rows, counts), strict=True))
    assert len(layers[3].size) < len(np.unique(rows[:, :3], axis=0))
    import pyarrow as pa
    names, again = C.unpacked(C.packed(pa.array([b"a", b"b", b"c", b"d", b"e"], pa.large_binary()), layers))
    assert names == [b"a", b"b", b"c", b"d", b"e"]
    assert all((a == b).all() for a, b in zip(C.spelled(again), (rows, counts), strict=True))


def test_states_with_equal_hashes_are_kept_apart(monkeypatch):
    monkeypatch.setattr(C.words, "mix", lambda x: np.zeros_like(x))
    rows, counts = C.summed(np.random.default_rng(1).integers(0, 4, (300, 4)), np.arange(300))
    assert all((a == b).all() for a, b in zip(C.spelled(C.transducer(rows, counts)), (rows, counts), strict=True))


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**18
    counts = spark.createDataFrame([("en", "", 0, big), ("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)],
                                   "lang string, phrase string, words int, f long")
    assert C.scored(counts).select("score").first().score == 2000000 * (big - 1) // (2 * big)


def test_query_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    got = sorted(map(tuple, entry.queries()["op11_collocations"](spark, SF).collect()))
    assert got == plain(rows) and got
