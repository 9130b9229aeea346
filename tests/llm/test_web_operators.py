"""URL filter and WARC archives."""

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emporia.llm import url_filter, warc
from emporia.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder():
    with tempfile.TemporaryDirectory(dir=os.environ.get("EMPORIA_SCRATCH")) as d:
        yield d


def plain_verdict(url, listed):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    key = host + path
    return host, path, rule.text if rule else None, rule.verdict if rule else ("block" if key and key in listed else "allow")


def test_verdicts_equal_the_plain_ones(spark):
    urls = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://Example.ORG", "http://example.org/", "http://a.example.org/es/x",
             "http://badexample.org/es/", "http://example.org/en/1", "http://example.org/en/2", "http://x.com/fr/1?y#z",
             "http://x.com?/fr/", "a://b://c/d", "http://host#/p", "http://ÄB.com/de/ü", "http://x.net/p?q", "http://x.net/p#f"]
    urls += ["http://x.net/p"] * 30
    pages = spark.createDataFrame([(i, u, "block", "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    listed = {"x.net/p", "b:", "x.com/fr/1", urls[3].split("://")[1], ""}
    frame = spark.createDataFrame([(x,) for x in [*listed, None, "x.net/p"]], "key string")
    got = url_filter.judge(pages.repartition(3), frame, URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id], listed)


def test_shards_do_not_change_the_result(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id")).alias("k"))
    listed = keys.filter("hash(k) % 3 = 0").union(keys.limit(5))
    for size in (100, 1 << 20):
        got = {r.k for r in url_filter.listed_keys(keys, listed, "k", size).collect()}
        assert got == {r.k for r in listed.collect()}
    assert url_filter.listed_keys(keys, listed.limit(0), "k").collect() == []
    assert url_filter.listed_keys(keys.limit(0), listed, "k").collect() == []


def test_equal_digests_are_settled_by_the_strings(folder):
    array = url_filter.DigestArray(np.array([7, 7, 9], dtype=np.uint64), pa.array(["a", "b", "c"]), folder)
    assert isinstance(array.digests, np.memmap)
    probe = array.holds(np.array([7, 7, 7, 9, 8], dtype=np.uint64), pa.array(["b", "x", "a", "d", "c"]))
    assert probe.tolist() == [True, False, True, False, False]


BIG = "é" * 700
ROWS = [
    (1, "http://a/x", BIG), (2, "http://b", BIG), (7, None, BIG), (4, "http://c\r\nX: 1", None), (5, "http://d", ""),
    (3, "http://c", "a\r\n\r\nb" + warc.MARK + "response\r\n\r\nZ" + warc.MARK + warc.MARK + "é\r\n0\r\n\r\n" + BIG),
    (8, "u", "x"), (9, "u", "x"), (10, "v", warc.MARK), (11, "v", "WARC/1.1\r\nWARC-Type"), (12, "v", "z\r\n"),
    (13, "v", "\r\nWARC/1.1"), (14, "v", "y" * 999), (15, "v", "y" * 999), (16, "v", "y" * 1000), (17, "v", "y" * 1000)]


def plain_captures(rows):
    out = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        refers = max(same) if len(raw) >= 1000 and max(same) != i else None
        out[i] = (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers is not None else "response", refers)
    return out


@pytest.mark.parametrize("groups", [warc.BROADCAST_GROUPS, 0])
def test_round_trip(spark, folder, monkeypatch, groups):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", groups)
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string").repartition(2)
    warc.write(pages, f"{folder}/w")
    assembled = warc.assemble(warc.read(spark, f"{folder}/w"))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.captures(assembled).collect()}
    assert got == plain_captures(ROWS)
    html = {i: h or "" for i, _, h in ROWS}
    for r in assembled.collect():
        if r.response.record_type == "response":
            assert r.response.payload == html[r.metadata.page_id]
        assert r.request.record_id == f"{r.capture_id}:request" and r.metadata.record_id == f"{r.capture_id}:metadata"
    urls = {r.page_id: r.url for r in warc.captures(assembled).collect()}
    assert urls[7] is None and urls[4] == "http://c%0D%0AX:%201" and urls[1] == "http://a/x"


def test_archive_is_a_sequence_of_whole_records(spark, folder):
    """Read with the lengths alone, as any other reader does."""
    warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1), f"{folder}/w")
    name = next(x for x in os.listdir(f"{folder}/w") if x.startswith("part"))
    with open(f"{folder}/w/{name}", "rb") as f:
        data = f.read()
    kinds = []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and {"WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length"} <= fields.keys()
        size = int(fields["Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        kinds.append(fields["WARC-Type"])
        data = rest[size + 4:]
    assert kinds.count("request") == kinds.count("metadata") == len(ROWS) and kinds.count("revisit") == 3


def test_splits_neither_lose_nor_repeat_records(spark, folder):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://x/y").alias("url"),
                                    F.repeat(F.concat(F.lit("WARC/1.1\r\n"), F.col("id").cast("string")), 20).alias("html"))
    warc.write(pages.coalesce(1), f"{folder}/w")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4099b")
        records = warc.read(spark, f"{folder}/w")
        assert records.rdd.getNumPartitions() > 10
        assert records.groupBy("record_type").count().orderBy("record_type").collect() == [
            ("metadata", 400), ("request", 400), ("response", 400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_nulls_repeats_and_missing_records(spark, folder):
    rows = [(None, "http://n", BIG), (None, "http://n2", "x"), (5, "a", BIG), (5, "a", BIG), (6, "b", "q")]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{folder}/w")
    records = warc.read(spark, f"{folder}/w", payloads=False)
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.captures(warc.assemble(records)).collect())
    assert got == [("5", "response", None), ("6", "response", None), ("None", "response", None), ("None", "revisit", 5)]
    alone = warc.assemble(records.filter("record_type <> 'request'")).collect()
    assert len(alone) == 4 and all(r.request is None for r in alone)


def test_damaged_archive_is_an_error(spark, folder):
    os.mkdir(f"{folder}/w")
    with open(f"{folder}/w/part-0", "wb") as f:
        f.write((warc.MARK + "response\r\nWARC-Record-ID: <x>\r\nContent-Length: 100\r\n\r\nHTTP/1.1 200 OK\r\n\r\nshort\r\n\r\n").encode())
    with pytest.raises(Exception, match="Content-Length"):
        warc.read(spark, f"{folder}/w").collect()


def test_empty_table(spark, folder):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{folder}/w")
    assert warc.captures(warc.assemble(warc.read(spark, f"{folder}/w"))).collect() == []
