"""Substring de-duplication by radix sort against a plain version over all windows."""

import random

import numpy as np
import pytest
from llm_brute import by_id, byte_dedup
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emporia.llm import radix_dedup as R

SF = "/root/testdata/sf0.001"


def got(spark, rows, window, parts=4):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n int, mark string, _doc int")
    out = R.dedup(docs.repartition(parts), window)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    return by_id(map(tuple, out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()))


def odd_rows(seed):
    """Random texts over a small alphabet with shared passages, periods, repeats, nulls and repeated ids."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdéß ") for _ in range(rng.randrange(20, 120))) for _ in range(8)]
    rows = [(None, passages[0]), (None, passages[0] * 2), (1, None), (2, ""), (3, "a" * 500), (4, "ab" * 300), (5, "abc" * 90),
            (6, "x" * 39), (7, "x" * 40), (8, "x" * 41), (9, passages[1]), (9, passages[1]), (9, passages[2] + "Q"), (10, passages[2] + "R")]
    for i in range(11, 120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
                 for _ in range(rng.randrange(6))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("window,gram,hot", [(40, 8, False), (40, 8, True), (33, 4, False), (150, 32, False)])
def test_equals_all_windows(spark, monkeypatch, window, gram, hot):
    monkeypatch.setattr(R, "GRAM", gram)
    monkeypatch.setattr(R, "PIECE", 300)
    monkeypatch.setattr(R, "CHUNK_BYTES", 900)
    monkeypatch.setattr(R, "SORT_BYTES", 2000)
    monkeypatch.setattr(R, "BUCKET_BYTES", 3000)
    if hot:
        monkeypatch.setattr(R, "SAMPLE", 1)
        monkeypatch.setattr(R, "SPLIT_BYTES", 1500)
    rows = odd_rows(window)
    assert got(spark, rows, window) == by_id(byte_dedup(rows, window))


def test_hash_collisions_are_settled_on_bytes(monkeypatch):
    """Digits of one value: every group is decided by the bytes alone."""
    monkeypatch.setattr(R, "GRAM", 4)
    monkeypatch.setattr(R, "rolling", lambda data, sizes: {s: np.zeros(len(data) - s + 1, dtype=np.uint64) for s in sizes})
    strings = [b"abcdefghij", b"abcdefghiX", b"Xbcdefghij", b"abcdefghij"[::-1]]
    flags = R._windows_of(np.zeros(4, dtype=np.int64), strings, np.array([2, 2, 2, 2]), np.array([3, 3, 3, 3]), 8)
    windows = [s[i:i + 8] for s in strings for i in range(3)]
    aligned = [(w, k % 3) for k, w in enumerate(windows)]
    assert flags.tolist() == [aligned.count(x) > 1 for x in aligned]


def test_join_of_many_spans_and_empty_table(spark, monkeypatch):
    rows = odd_rows(5)
    monkeypatch.setattr(R, "GRAM", 8)
    monkeypatch.setattr(R, "BROADCAST_IDS", 0)
    assert got(spark, rows, 40) == by_id(byte_dedup(rows, 40))
    assert got(spark, [], 40) == []


def test_one_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 1 << 14)
    rng = random.Random(2)
    part = "".join(rng.choice("abcdefghijklmnop") for _ in range(5000))
    rows = [(1, "".join(rng.choice("abcdefghijklmnop") for _ in range(100_000)) + part + "z" + part), (2, part[100:700])]
    assert got(spark, rows, 400) == by_id(byte_dedup(rows, 400))


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = entry.queries()["op12_radix_dedup"](spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    result = by_id(map(tuple, out.collect()))
    assert result == by_id(byte_dedup(rows)) and any(r[2] for r in result)
