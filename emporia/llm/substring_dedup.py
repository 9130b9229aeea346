"""Substring de-duplication with super-k-mer partitioning.

A window is ``k`` consecutive words of one document. The minimiser of a window
is the smallest hash among its ``m``-word parts; consecutive windows that share
their minimiser travel as one packed string (a super-k-mer) to the bucket that
the minimiser names. Equal windows have equal minimisers, so a bucket holds
all occurrences of its windows: there they are sorted by hash, equal hashes
are confirmed on the words themselves, and each window that a document with a
smaller id also holds is reported. Words covered by reported windows are
removed.

Shuffled data is combined first: of equal super-k-mers in one chunk of a task,
only the smallest document is sent; the later ones are reported on the spot,
since that document is smaller than theirs. A passage or text that a third of
all documents share therefore reaches its buckets once per chunk.

Defined results: a null or empty text has no words; a document without an id
neither loses words nor makes others lose any; rows that repeat an id are not
smaller than each other, and each loses its own words (rows equal in id and
text the same ones); only ``doc_id`` and ``text`` are read; an
empty table gives an empty table. Texts of any length are handled whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm import words
from emporia.plans.session import ensure_checkpoint_dir

K = 13
M = 3
BUCKET_BYTES = 4 << 20
CHUNK_BYTES = 4 << 20
BROADCAST_IDS = 1 << 19     # documents that lose words, 16 bytes each
_PACKED = "bucket long, raw_bytes long, packed binary, doc_id long, mark long, first int, n int"
_SPANS = "doc_id long, mark long, first int, n int"


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def super_kmers(w: words.Words, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, minimiser) of each super-k-mer of the texts, in order."""
    h = w.hashes()
    at, _ = w.windows(h, k)
    if not len(at):
        return at, at, np.empty(0, dtype=np.uint64)
    parts = np.zeros(len(h) - m + 1, dtype=np.uint64)
    for j, p in enumerate(words.powers(m)):
        parts += h[j:j + len(parts)] * p
    parts = words.mix(parts)
    n = len(h) - k + 1
    least = parts[:n].copy()
    for j in range(1, k - m + 1):
        np.minimum(least, parts[j:j + n], out=least)
    least = least[at]
    new = np.concatenate(([True], (np.diff(at) != 1) | (least[1:] != least[:-1])))
    begin = np.flatnonzero(new)
    return at[begin], np.diff(np.append(begin, len(at))), least[begin]


def canonical(w: words.Words) -> tuple[bytes, np.ndarray]:
    """All words with one space behind each, and where each begins (one entry more at the end)."""
    texts = [b" ".join(t) for i in range(len(w.first) - 1) if (t := w.text(i).split())]
    return b" ".join([*texts, b""]), np.concatenate(([0], np.cumsum(w.ends - w.starts + 1)))


def _pack(batches: Iterator[pa.RecordBatch], buckets: int, k: int, m: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    codec = _codec()
    for b in words.freed(batches):
        ids, marks = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "mark"))
        for lo, hi, w in words.chunks(b.column("text"), chunk_bytes):
            first, count, least = super_kmers(w, k, m)
            if not len(first):
                continue
            text, begin = canonical(w)
            owner = np.searchsorted(w.first, first, "right") - 1
            doc, place = ids[lo:hi][owner].astype(np.int64), (first - w.first[owner]).astype(np.int64)
            mark = marks[lo:hi][owner].astype(np.int64)
            begin_at, end_at = begin[first].tolist(), (begin[first + count + k - 1] - 1).tolist()
            order = np.lexsort((place, mark, doc))
            seen: dict[bytes, list] = {}
            again: dict[tuple[bytes, int], list] = {}
            later: list[int] = []
            docs, rows_of, places = doc.tolist(), mark.tolist(), place.tolist()
            for i in order.tolist():
                s = text[begin_at[i]:end_at[i]]
                known = seen.get(s)
                if known is None:
                    seen[s] = [i, places[i]]
                elif docs[known[0]] == docs[i]:
                    if rows_of[known[0]] == rows_of[i]:
                        known.append(places[i])
                    else:                       # another text of the id: an entry of its own
                        again.setdefault((s, rows_of[i]), [i]).append(places[i])
                else:
                    later.append(i)
            if later:
                rows = np.array(later)
                # Names below 0 spread them by document.
                away = -1 - (words.mix(doc[rows].astype(np.uint64)) >> np.uint64(2)).astype(np.int64)
                yield _rows(len(rows), bucket=away, doc_id=doc[rows], mark=mark[rows], first=place[rows], n=count[rows])
            strings, entries = [*seen, *[s for s, _ in again]], [*seen.values(), *again.values()]
            kept = np.array([e[0] for e in entries])
            bucket = (words.mix(least[kept]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            names, sizes, blobs = [], [], []
            for a, z in zip(edges, np.append(edges[1:], len(order)), strict=True):
                part = order[a:z].tolist()
                head = np.array([f(entries[i][0]) for f in (docs.__getitem__, rows_of.__getitem__) for i in part], dtype="<i8")
                repeats = np.array([len(entries[i]) - 1 for i in part], dtype="<i4")
                at = np.array([p for i in part for p in entries[i][1:]], dtype="<i4")
                raw = b"".join([np.array([len(part), len(at)], dtype="<i8").tobytes(), head.tobytes(), repeats.tobytes(),
                                at.tobytes(), b"\n".join([strings[i] for i in part])])
                names.append(int(bucket[part[0]]))
                sizes.append(len(raw))
                blobs.append(codec.compress(raw, asbytes=True))
            yield _rows(len(names), bucket=np.array(names), raw_bytes=np.array(sizes), packed=blobs)


def _rows(size: int, /, **columns) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "raw_bytes": pa.int64(), "packed": pa.binary(), "doc_id": pa.int64(), "mark": pa.int64(),
             "first": pa.int32(), "n": pa.int32()}
    return pa.RecordBatch.from_pydict({c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t)
                                       for c, t in kinds.items()})


def _unpack(raw: bytes):
    n, places = np.frombuffer(raw, "<i8", 2)
    at = 16 + 16 * n
    return (np.frombuffer(raw, "<i8", 2 * n, 16).reshape(2, n), np.frombuffer(raw, "<i4", n, at),
            np.frombuffer(raw, "<i4", places, at + 4 * n), raw[at + 4 * n + 4 * places:])


def later_windows(data: bytes, at: np.ndarray, w: words.Words, doc: np.ndarray, k: int, hashes: np.ndarray) -> np.ndarray:
    """Which windows (first words ``at``, owners ``doc``) have an equal one with a smaller owner.

    Windows are sorted by hash; within a run of equal hashes the words decide.
    """
    order = np.lexsort((doc, hashes))
    sorted_h, sorted_doc = hashes[order], doc[order]
    head = np.concatenate(([True], sorted_h[1:] != sorted_h[:-1]))
    run = np.cumsum(head) - 1
    begin = np.flatnonzero(head)
    later = sorted_doc > sorted_doc[begin][run]
    # Confirm on the words: a window that differs from the first of its run is settled among its like.
    many = np.flatnonzero(~head)
    starts, ends = w.starts[at][order], w.ends[at + k - 1][order]
    lead = begin[run[many]]
    odd = [i for i, s, e, s0, e0 in zip(many.tolist(), starts[many].tolist(), ends[many].tolist(), starts[lead].tolist(),
                                        ends[lead].tolist(), strict=True) if data[s:e] != data[s0:e0]]
    for r in {int(run[i]) for i in odd}:
        least: dict[bytes, int] = {}
        stop = begin[r + 1] if r + 1 < len(begin) else len(order)
        for i in range(begin[r], stop):
            s = data[starts[i]:ends[i]]
            later[i] = least.setdefault(s, sorted_doc[i]) < sorted_doc[i]
    out = np.zeros(len(at), dtype=bool)
    out[order] = later
    return out


def _bucket_spans(parts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, mark, first word, number of windows) of the reported windows of one bucket."""
    heads, repeats, places, texts = zip(*map(_unpack, parts), strict=True)
    (head, mark), repeat, place = np.concatenate(heads, axis=1), np.concatenate(repeats), np.concatenate(places)
    data = b"\n".join(texts)
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw == 0x0A)
    # The line feed between two strings belongs to the first of them, where it separates words from nothing.
    w = words.split(raw, np.concatenate(([0], ends + 1, [len(raw)])))
    at, h = w.windows(w.hashes(), k)
    owner = np.searchsorted(w.first, at, "right") - 1
    hit = later_windows(data, at, w, head[owner], k, h)
    at, owner = at[hit], owner[hit]
    if not len(at):
        return (np.empty(0, dtype=np.int64),) * 4
    begin = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(owner) != 0))))
    count = np.diff(np.append(begin, len(at)))
    owner, offset = owner[begin], at[begin] - w.first[owner[begin]]
    # Each span once for every place of its super-k-mer in the document.
    where = np.concatenate(([0], np.cumsum(repeat)))
    times = repeat[owner]
    span = np.repeat(np.arange(len(owner)), times)
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    return head[owner][span], mark[owner][span], place[where[owner][span] + nth] + offset[span], count[span]


def _count(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: reported spans pass, packed strings are counted bucket by bucket."""
    codec, bucket, parts = _codec(), None, []

    def out(doc, mark, first, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(mark, pa.int64()), pa.array(first, pa.int32()),
                                           pa.array(n, pa.int32())], ["doc_id", "mark", "first", "n"])

    for b in batches:
        name = b.column("bucket").to_numpy()
        passed = b.filter(pa.array(name < 0))
        if passed.num_rows:
            yield passed.select(["doc_id", "mark", "first", "n"])
        for i in np.flatnonzero(name >= 0).tolist():
            if parts and name[i] != bucket:
                yield out(*_bucket_spans(parts, k))
                parts = []
            bucket = name[i]
            parts.append(codec.decompress(b.column("packed")[i].as_buffer(), b.column("raw_bytes")[i].as_py(), asbytes=True))
    if parts:
        yield out(*_bucket_spans(parts, k))


def repeated_spans(docs: DataFrame, k: int = K, m: int = M, bucket_bytes: int = BUCKET_BYTES,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, mark, first, n): runs of ``n`` windows from word ``first`` on that a smaller document also holds.

    The number of buckets follows the corpus size, so a bucket's memory does not.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    rows = rows.filter("doc_id is not null")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, ceil(size / bucket_bytes))
    packed = rows.mapInArrow(lambda it: _pack(it, buckets, k, m, chunk_bytes), _PACKED)
    return words.dealt(packed, "bucket", 3 * size).sortWithinPartitions("bucket").mapInArrow(lambda it: _count(it, k), _SPANS)


def _finish(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        firsts, counts = b.column("firsts").to_pylist(), b.column("counts").to_pylist()
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(b.column("text").cast(pa.large_binary())):
            parts = (text.as_py() or b"").split()
            n_words.append(len(parts))
            if firsts[i]:
                cover = np.zeros(len(parts) + 1, dtype=np.int64)
                start = np.array(firsts[i])
                np.add.at(cover, start, 1)
                np.subtract.at(cover, start + np.array(counts[i]) + k - 1, 1)
                gone = np.cumsum(cover[:-1]) > 0
                n_removed.append(int(gone.sum()))
                parts = [parts[j] for j in np.flatnonzero(~gone).tolist()]
            else:
                n_removed.append(0)
            kept.append(b" ".join(parts).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})


def dedup(docs: DataFrame, k: int = K, m: int = M, **sizes: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the kept words joined by one space) for every row."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/substring-dedup-{uuid.uuid4().hex}"
    (repeated_spans(docs, k, m, **sizes).groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"))
     .agg(F.collect_list("first").alias("firsts"), F.collect_list("n").alias("counts")).write.parquet(path))
    spans = spark.read.parquet(path)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    ids, match = spans.select("_doc", "_mark"), (F.col("doc_id") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    none = F.lit(None).cast("array<int>")
    if spans.count() <= BROADCAST_IDS:
        # Only texts that lose words are shuffled.
        some = rows.join(F.broadcast(ids), match, "left_semi").join(spans, match)
        others = rows.join(F.broadcast(ids), match, "left_anti").select("*", none.alias("firsts"), none.alias("counts"))
        parts = [some, others]
    else:
        parts = [rows.join(spans, match, "left")]
    finished = [p.select("doc_id", "text", "firsts", "counts").mapInArrow(
        lambda it: _finish(it, k), "doc_id long, n_words long, n_removed long, kept_text string") for p in parts]
    return reduce(DataFrame.unionByName, finished)
