"""Merkle manifest: bitmaps, slots, paths and the query, against a plain version."""

import random

import numpy as np
import pytest
from llm_brute import merkle as plain
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emporia.llm import merkle

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"
KEY = lambda r: [(x is not None, x) for x in r]


def verified(spark, monkeypatch, rows, extra=False):
    """What op13 gives for rows of a table of their own."""
    from emporia.llm import queries

    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if extra:
        docs = docs.withColumns({c: F.lit("x") for c in ("_group", "_at", "leaf", "path", "_key", "subroot", "_deal")})
    monkeypatch.setattr(queries, "_table", lambda *a: docs)
    return sorted(map(tuple, queries.op13_merkle(spark, "").collect()), key=KEY)


def test_bitmaps_merge_and_rank():
    rng = np.random.default_rng(1)
    for size, span in ((1, 1), (50, 65536), (3000, 65536), (4096, 65536), (30000, 65536), (65536, 65536), (900, 3)):
        lows = rng.integers(0, span, size)
        half = [merkle._merged(x, np.ones(len(x), dtype=np.int64)) for x in (lows[:size // 2], lows[size // 2:]) if len(x)]
        bitmap = merkle.KeyBitmap.unpack(merkle._merged(*map(np.concatenate, zip(*map(merkle._counted, half), strict=True))))
        assert (bitmap.lows == np.unique(lows)).all()
        at = np.unique(lows)
        assert (bitmap.rank(at) == np.searchsorted(np.sort(lows), at)).all()


def test_leaf_marks_nulls(spark):
    row = spark.sql("SELECT merkle.* FROM (SELECT null a, '' b, 12 c, 'é' d) merkle").select(
        merkle.leaf_hash(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("h")).first()
    from llm_brute import sha256
    assert row.h == sha256("-0:2:122:é")


def test_equals_plain_version_on_odd_rows(spark, monkeypatch):
    rng = random.Random(3)
    keys = [None, 0, -1, 5, 65535, 65536, 2**47, -2**47, 2**63 - 1, -2**63, *range(100, 140), *[rng.getrandbits(63) for _ in range(40)]]
    rows = [(rng.choice(keys), rng.choice([None, "", "a", "b", "é", "Z" * 300, "-", "="]), rng.choice([None, "en"]),
             rng.choice([None, 3]), rng.choice([None, "", "Upper", "lower", "ß É", f"t{i}"])) for i in range(500)]
    rows += [(7, "a", "en", 1, "same")] * 40 + [(7, "a", "en", 1, f"other {i}") for i in range(40)]
    monkeypatch.setattr(merkle, "PIECE", 3)
    assert verified(spark, monkeypatch, rows, extra=True) == sorted(plain(rows), key=KEY)


def test_many_levels_and_blocks(spark, monkeypatch):
    """Blocks of one level each make several rounds; many groups make a high top tree."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "ROWS_PER_DEAL", 50)
    rows = [(i * 977, f"s{i % 3}", "en", i, f"Text {i}") for i in range(900)]
    rows += [(i, f"g{i}", None, None, None) for i in range(300)]
    assert verified(spark, monkeypatch, rows) == sorted(plain(rows), key=KEY)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(5, "a", "en", 1, "ONE")], [(1, "a", "x", 1, "t")] * 17])
def test_small_tables(spark, monkeypatch, rows):
    assert verified(spark, monkeypatch, rows) == sorted(plain(rows), key=KEY)


def test_interface_and_subroots(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = merkle.build(docs, FIELDS, carry=["lang"])
    rows = m.paths()
    assert rows.columns == ["doc_id", "source", "slot", "leaf", "subroot", "root", "path", "lang"]
    assert rows.select(merkle.fold(F.col("leaf"), F.col("path"))).distinct().collect()[0][0] == m.root
    assert m.subroots().count() == docs.select("source").distinct().count()
    slots = rows.groupBy("source").agg(F.min("slot"), F.max("slot") + 1, F.count_distinct("slot"), F.count("*")).collect()
    assert all(r[1] == 0 and r[2] == r[3] == r[4] for r in slots)


def test_query_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*FIELDS).collect()]
    got = entry.queries()["op13_merkle"](spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=KEY)
    assert got == sorted(plain(rows), key=KEY)
    assert {r[-1] for r in got} == {True, False}
