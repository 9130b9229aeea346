"""Substring de-duplication by a depth-limited radix sort of suffixes.

A window is ``window`` consecutive bytes of one document. Suffixes are ordered
only through their first ``window`` bytes, most significant digit first; the
groups that are equal to that depth are exactly the windows that occur more
than once, and every byte that such a window covers is removed, the first
occurrence included.

Digits. The first digit of a window is its anchor: the ``GRAM``-byte string
inside it with the smallest hash (the leftmost one), and where it stands in the
window. Equal windows have equal anchors, and consecutive windows share theirs,
so this digit deals the suffixes out to the tasks as runs: a packed string goes
to the bucket of its anchor. There the runs whose anchor occurs once are done.
The windows of the others are ordered by further digits of up to 128 bytes
each, by value of a 64-bit hash; after each pass the windows that are alone in
their group are done. Groups that are left are confirmed on their bytes.

Of equal strings in a chunk of a task one is sent, without a place: both
occurrences are reported on the spot. Anchors that many runs share (found in a
sample of the documents, which steers the routing and no result) would fill
one bucket; their windows are dealt out one by one by a 128-bit hash of all
their bytes, counted with partial sums, and joined back.

Defined results: a null or empty text has no bytes; texts shorter than a
window lose nothing and take part in nothing; rows that repeat an id are
documents of their own (equal rows lose what they share), rows without an id
too; a character may lose some of its bytes, so what is left is binary; only
``doc_id`` and ``text`` are read; an empty table gives an empty table. Texts
of any length are handled whole, in overlapping pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm import words
from emporia.plans.session import ensure_checkpoint_dir

WINDOW = 400
GRAM = 32                   # bytes of an anchor, a power of two
WIDEST = 128                # bytes of a digit at most
PIECE = 1 << 20             # bytes whose windows are hashed at once
CHUNK_BYTES = 8 << 20       # bytes of text whose equal strings are combined
BUCKET_BYTES = 4 << 20      # text per bucket
SPLIT_BYTES = 8 << 20       # strings of one anchor beyond this are dealt out by window
SAMPLE = 64                 # one document in SAMPLE is looked at for such anchors
SORT_BYTES = 4 << 20        # strings whose windows are sorted at once
BROADCAST_IDS = 1 << 19     # documents that lose bytes, 16 bytes each
_POSITION = np.uint64((1 << 21) - 1)
_BYTES = words.mix(np.arange(1, 257, dtype=np.uint64))
_PACKED = "bucket long, raw_bytes long, packed binary, doc long, mark long, first long, n int"
_SPANS = "doc long, mark long, first long, n int"
_KINDS = {"bucket": pa.int64(), "raw_bytes": pa.int64(), "packed": pa.binary(), "doc": pa.int64(), "mark": pa.int64(),
          "first": pa.int64(), "n": pa.int32()}


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def digit_sizes(window: int) -> list[int]:
    """Powers of two up to ``WIDEST`` that add up to ``window``, widest first."""
    out = [WIDEST] * (window // WIDEST)
    return out + [1 << b for b in reversed(range(WIDEST.bit_length() - 1)) if window % WIDEST >> b & 1]


def rolling(data: np.ndarray, sizes: set[int]) -> dict[int, np.ndarray]:
    """Hashes of all substrings of each size (powers of two), by doubling."""
    out, h, size, power = {}, _BYTES[data], 1, 0x9E3779B97F4A7C15
    while True:
        if size in sizes:
            out[size] = h
        if size >= max(sizes) or len(h) <= size:
            return out
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = 2 * size, power * power % (1 << 64)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return keys if size == width else np.minimum(keys[:size - width], keys[width - size:])


def _pieces(offsets: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, start, end): byte ranges of about ``PIECE``; a long text is cut, with an overlap."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = min(max(int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1, at + 1), n)
        if end == at + 1 and offsets[end] - offsets[at] > PIECE:
            for start in range(int(offsets[at]), int(offsets[end]) - window + 1, PIECE):
                yield at, end, start, min(start + PIECE + window - 1, int(offsets[end]))
        elif offsets[end] - offsets[at] >= window:
            yield at, end, int(offsets[at]), int(offsets[end])
        at = end


def runs(data: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, place of the anchor, its hash) of each run; ``bounds`` are the texts' own."""
    hashes = words.mix(rolling(data, {GRAM})[GRAM])
    keys = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(keys, window - GRAM + 1) & _POSITION).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, dtype=np.int64)
    begin, end = bounds[:-1], bounds[1:] - window + 1
    some = end > begin
    inside[begin[some]] += 1
    np.subtract.at(inside, end[some], 1)
    ok = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    # A run ends where the text does: the next text's first window has another anchor.
    new = np.concatenate(([True], (np.diff(ok) != 1) | (np.diff(anchor[ok]) != 0)))[:len(ok)]
    first = ok[new]
    count = np.diff(np.append(np.flatnonzero(new), len(ok)))
    return first, count, anchor[first], hashes[anchor[first]]


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("text").cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, dtype=np.uint8)
    return data, offsets


def _runs_of(batches: Iterator[pa.RecordBatch], window: int):
    """(bytes, doc, mark, place in the text, first, count, anchor, hash) of the runs of each piece."""
    for b in words.freed(batches):
        data, offsets = _texts(b)
        doc, mark = b.column("doc").to_numpy(), b.column("mark").to_numpy()
        for lo, hi, start, end in _pieces(offsets, window):
            bounds = np.clip(offsets[lo:hi + 1], start, end) - start
            first, count, anchor, h = runs(data[start:end], bounds, window)
            row = lo + np.searchsorted(bounds, first, "right") - 1
            yield data[start:end], doc[row], mark[row], start + first - offsets[row], first, count, anchor, h


def _rows(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in _KINDS.items()})


def _span_rows(doc, mark, first, n) -> pa.RecordBatch:
    """Spans that are known already; names below 0 spread them by document."""
    doc, mark = np.array(doc, dtype=np.int64), np.array(mark, dtype=np.int64)
    away = -1 - (words.mix((doc ^ mark).view(np.uint64)) >> np.uint64(2)).astype(np.int64)
    return _rows(len(doc), bucket=away, doc=doc, mark=mark, first=np.array(first), n=np.array(n))


class _Chunk:
    """The strings of a chunk of text: equal ones are held once."""

    def __init__(self):
        self.seen: dict[bytes, list] = {}
        self.known: list[tuple] = []
        self.size = 0

    def add(self, text: np.ndarray, doc, mark, place, first, count, anchor, h, window: int) -> None:
        self.size += len(text)
        raw = text.tobytes()
        ends, offset = (first + count + window - 1).tolist(), (anchor - first).tolist()
        rows = zip(first.tolist(), ends, doc.tolist(), mark.tolist(), place.tolist(), count.tolist(), offset, h.tolist(), strict=True)
        for a, z, d, m, p, n, o, g in rows:
            s = raw[a:z]
            entry = self.seen.get(s)
            if entry is None:
                self.seen[s] = [g, o, n, d, m, p]
                continue
            if entry[5] >= 0:
                self.known.append((entry[3], entry[4], entry[5], n))
                entry[3:] = 0, 0, -1
            self.known.append((d, m, p, n))

    def batches(self, buckets: int, codec: pa.Codec) -> Iterator[pa.RecordBatch]:
        if self.known:
            yield _span_rows(*zip(*self.known, strict=True))
        if not self.seen:
            return
        strings, entries = list(self.seen), list(self.seen.values())
        h = np.array([e[0] for e in entries], dtype=np.uint64)
        table = np.array([e[1:] for e in entries], dtype=np.int64)
        lens = np.array([len(s) for s in strings], dtype=np.int64)
        bucket = (words.mix(h) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((h, bucket))
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        names, sizes, blobs = [], [], []
        for a, z in zip(edges, np.append(edges[1:], len(order)), strict=True):
            part = order[a:z]
            raw = b"".join([np.int64(len(part)).tobytes(), h[part].tobytes(), table[part].T.tobytes(), lens[part].tobytes(),
                            *[strings[i] for i in part.tolist()]])
            names.append(int(bucket[part[0]]))
            sizes.append(len(raw))
            blobs.append(codec.compress(raw, asbytes=True))
        yield _rows(len(names), bucket=np.array(names), raw_bytes=np.array(sizes), packed=blobs)


def _pack(batches: Iterator[pa.RecordBatch], buckets: int, window: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    codec, chunk = _codec(), _Chunk()
    for text, *columns in _runs_of(batches, window):
        if len(hot):
            cold = ~np.isin(columns[-1], hot)
            columns = [c[cold] for c in columns]
        chunk.add(text, *columns, window)
        if chunk.size >= CHUNK_BYTES:
            yield from chunk.batches(buckets, codec)
            chunk = _Chunk()
    yield from chunk.batches(buckets, codec)


# -- buckets ---------------------------------------------------------------------


class _Strings:
    """Strings of one bucket in the order of their anchors."""

    def __init__(self, blobs: list[bytes]):
        hashes, tables, lens, texts = [], [], [], []
        for raw in blobs:
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            hashes.append(np.frombuffer(raw, "<u8", n, 8))
            tables.append(np.frombuffer(raw, "<i8", 5 * n, 8 + 8 * n).reshape(5, n))
            lens.append(np.frombuffer(raw, "<i8", n, 8 + 48 * n))
            ends = 8 + 56 * n + np.cumsum(lens[-1])
            texts += [raw[z - k:z] for z, k in zip(ends.tolist(), lens[-1].tolist(), strict=True)]
        h, table = np.concatenate(hashes), np.concatenate(tables, axis=1)
        order = np.argsort(h, kind="stable")
        h = h[order]
        edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.append(edge, len(h)))
        # The first pass: strings alone with their anchor are done.
        keep = np.repeat(size > 1, size)
        self.order = order[keep]
        self.group = np.repeat(np.arange(len(size)), size)[keep]
        self.offset, self.n, self.doc, self.mark, self.place = table[:, self.order]
        self.texts = [texts[i] for i in self.order.tolist()]


def _windows_of(group: np.ndarray, strings: list[bytes], offset: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Flags of the windows (string by string) that occur more than once among strings with one anchor each group."""
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(s) for s in strings])))[:-1]
    total = int(n.sum())
    owner = np.repeat(np.arange(len(strings)), n)
    at = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    base = begin[owner] + at
    # The rest of the first digit: where the anchor stands in the window.
    digit = (offset[owner] - at).astype(np.uint64)
    alive, gid = np.arange(total), group[owner]
    sizes = digit_sizes(window)
    hashes = rolling(data, set(sizes))
    depth = 0
    for size in [0, *sizes]:
        if size:
            digit = hashes[size][base[alive] + depth]
            depth += size
        order = np.lexsort((digit, gid))
        g, d = gid[order], digit[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])))[:len(g)]
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.zeros(0, dtype=bool)
        alive, gid = alive[order][many], number[many]
        if not len(alive):
            break
    flags = np.zeros(total, dtype=bool)
    flags[_confirmed(data.tobytes(), alive, gid, owner, at, base, window)] = True
    return flags


def _confirmed(data: bytes, alive: np.ndarray, gid: np.ndarray, owner: np.ndarray, at: np.ndarray, base: np.ndarray,
               window: int) -> np.ndarray:
    """The windows of groups whose bytes are equal; runs along two strings are compared at once."""
    if not len(alive):
        return alive
    lead = alive[np.concatenate(([True], gid[1:] != gid[:-1]))][np.unique(gid, return_inverse=True)[1]]
    order = np.lexsort((at[alive], owner[alive]))
    a, r, g = alive[order], lead[order], gid[order]
    new = np.concatenate(([True], (owner[a][1:] != owner[a][:-1]) | (owner[r][1:] != owner[r][:-1])
                          | (np.diff(base[a]) != 1) | (np.diff(base[r]) != 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    odd = [int(f) for f, p, q, k in zip(first, base[a[first]].tolist(), base[r[first]].tolist(), (last - first).tolist(), strict=True)
           if data[p:p + k + window] != data[q:q + k + window]]
    if not odd:
        return a
    ends = dict(zip(first.tolist(), last.tolist(), strict=True))
    wrong = np.isin(g, np.concatenate([g[f:ends[f] + 1] for f in odd]))
    same: dict[tuple, list] = {}
    for i, k in zip(a[wrong].tolist(), g[wrong].tolist(), strict=True):
        same.setdefault((k, data[base[i]:base[i] + window]), []).append(i)
    return np.concatenate([a[~wrong], np.array([i for v in same.values() if len(v) > 1 for i in v], dtype=np.int64)])


def _bucket_spans(blobs: list[bytes], window: int) -> Iterator[tuple]:
    """(doc, mark, first, n) of the repeated windows of one bucket."""
    s = _Strings(blobs)
    edge = np.flatnonzero(np.diff(s.group, prepend=-1)).tolist()
    group, members, strings, whole = [], [], [], []          # distinct strings that are still open
    size = 0

    def finish() -> Iterator[tuple]:
        lead = np.array([m[0] for m in members])
        n = s.n[lead]
        flags = _windows_of(np.array(group), strings, s.offset[lead], n, window)
        step = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
        begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # Cut the spans where strings meet.
        starts = np.cumsum(n) - n
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            k = int(np.searchsorted(starts, b, "right")) - 1
            while b < e:
                stop = min(e, int(starts[k] + n[k]))
                if not whole[k]:
                    i = members[k][0]
                    yield int(s.doc[i]), int(s.mark[i]), int(s.place[i]) + b - int(starts[k]), stop - b
                b, k = stop, k + 1

    for lo, hi in zip(edge, [*edge[1:], len(s.texts)], strict=True):
        same: dict[bytes, list[int]] = {}
        for i in range(lo, hi):
            same.setdefault(s.texts[i], []).append(i)
        for text, rows in same.items():
            full = len(rows) > 1 or s.place[rows[0]] < 0
            if full:
                for i in rows:
                    if s.place[i] >= 0:
                        yield int(s.doc[i]), int(s.mark[i]), int(s.place[i]), int(s.n[i])
            if len(same) > 1:
                group.append(lo)
                members.append(rows)
                strings.append(text)
                whole.append(full)
                size += len(text)
        if size >= SORT_BYTES:
            yield from finish()
            group, members, strings, whole, size = [], [], [], [], 0
    if strings:
        yield from finish()


def _sort(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: known spans pass, strings are sorted bucket by bucket."""
    codec, bucket, blobs = _codec(), None, []

    def out(spans: list[tuple]) -> pa.RecordBatch:
        doc, mark, first, n = np.array(spans, dtype=np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(mark), pa.array(first), pa.array(n, pa.int32())],
                                          ["doc", "mark", "first", "n"])

    for b in batches:
        name = b.column("bucket").to_numpy()
        known = b.filter(pa.array(name < 0))
        if known.num_rows:
            yield known.select(["doc", "mark", "first", "n"])
        for i in np.flatnonzero(name >= 0).tolist():
            if blobs and name[i] != bucket:
                yield out(list(_bucket_spans(blobs, window)))
                blobs = []
            bucket = name[i]
            blobs.append(codec.decompress(b.column("packed")[i].as_buffer(), b.column("raw_bytes")[i].as_py(), asbytes=True))
    if blobs:
        yield out(list(_bucket_spans(blobs, window)))


# -- anchors that many runs share --------------------------------------------------


def _anchor_bytes(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for _, _, _, _, _, count, _, h in _runs_of(batches, window):
        some, at = np.unique(h, return_inverse=True)
        size = np.bincount(at, weights=count + window - 1, minlength=len(some)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(some.view(np.int64)), "size": pa.array(size)})


def hot_anchors(rows: DataFrame, raw_bytes: int, window: int) -> np.ndarray:
    """Anchors whose strings take more than ``SPLIT_BYTES`` by a sample; 2**20 at most, as the bound grows beyond that."""
    sample = rows.filter(F.pmod(F.xxhash64("mark", F.lit("sample")), F.lit(SAMPLE)) == 0)
    sizes = sample.mapInArrow(lambda it: _anchor_bytes(it, window), "anchor long, size long").groupBy("anchor").agg(F.sum("size").alias("size"))
    found = sizes.filter(F.col("size") * SAMPLE >= max(SPLIT_BYTES, raw_bytes >> 20)).select("anchor").collect()
    return np.sort(np.array([r.anchor for r in found], dtype=np.int64).view(np.uint64))


def _hot_windows(batches: Iterator[pa.RecordBatch], window: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each window of a hot anchor by two hashes of its bytes; of equal ones in a piece one goes without a place, and all are reported."""
    sizes = digit_sizes(window)
    for text, doc, mark, place, first, count, _, h in _runs_of(batches, window):
        is_hot = np.isin(h, hot)
        if not is_hot.any():
            continue
        first, count = first[is_hot], count[is_hot]
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        base = np.repeat(first, count) + at
        row = [np.repeat(x[is_hot], count) for x in (doc, mark, place)]
        hashes, one, two, depth = rolling(text, set(sizes)), np.zeros(len(base), dtype=np.uint64), np.zeros(len(base), dtype=np.uint64), 0
        for size in sizes:
            digit = hashes[size][base + depth]
            one, two = words.mix(one + digit), words.mix((two ^ digit) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(size))
            depth += size
        order = np.lexsort((two, one))
        new = np.concatenate(([True], (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)))
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1
        lead = order[new]
        alone = ~many[new]
        spots = order[many]
        column = lambda a, b, t: pa.array(np.concatenate([a, b]), t)  # noqa: E731,B023
        yield pa.RecordBatch.from_pydict({
            "one": column(one[lead].view(np.int64), one[spots].view(np.int64), pa.int64()),
            "two": column(two[lead].view(np.int64), two[spots].view(np.int64), pa.int64()),
            "kind": pa.array(np.concatenate([np.where(alone, 0, 1), np.full(len(spots), 2)]), pa.int32()),
            "doc": column(row[0][lead], row[0][spots], pa.int64()), "mark": column(row[1][lead], row[1][spots], pa.int64()),
            "first": column(row[2][lead] + at[lead], row[2][spots] + at[spots], pa.int64())})


def _hot_spans(rows: DataFrame, window: int, hot, folder: str) -> DataFrame:
    """Spans of one window each. Kinds: 0 a window alone in its piece, 1 a repeated one, once, 2 its places."""
    rows.mapInArrow(lambda it: _hot_windows(it, window, hot.value), "one long, two long, kind int, doc long, mark long, first long").write.parquet(
        f"{folder}/hot")
    found = rows.sparkSession.read.parquet(f"{folder}/hot")
    counts = (found.filter("kind < 2").groupBy("one", "two").agg(F.count(F.lit(1)).alias("c"), F.max("kind").alias("k"))
              .filter("c > 1").select("one", "two"))
    shared = found.filter("kind = 0").join(counts, ["one", "two"], "left_semi")
    return shared.unionByName(found.filter("kind = 2")).select("doc", "mark", "first", F.lit(1).alias("n"))


# -- the operator ------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and (doc, mark): equal for equal rows only."""
    number, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    return docs.select(number.alias("doc_id"), text.alias("text"), F.coalesce(number, F.lit(0)).alias("doc"),
                       F.xxhash64(text, number.isNull()).alias("mark"))


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, mark, first, n): runs of ``n`` windows from byte ``first`` on, each of which occurs elsewhere too."""
    spark = docs.sparkSession
    rows = _keyed(docs).filter(F.octet_length("text") >= window).select("doc", "mark", "text")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, ceil(size / BUCKET_BYTES))
    hot = spark.sparkContext.broadcast(hot_anchors(rows, 3 * size, window))
    packed = rows.mapInArrow(lambda it: _pack(it, buckets, window, hot.value), _PACKED)
    spans = words.dealt(packed, "bucket", 3 * size).sortWithinPartitions("bucket").mapInArrow(lambda it: _sort(it, window), _SPANS)
    if not len(hot.value):
        return spans
    return spans.unionByName(_hot_spans(rows, window, hot, f"{ensure_checkpoint_dir(spark)}/radix-dedup-{uuid.uuid4().hex}"))


def _finish(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, firsts, counts in zip(b.column("text").cast(pa.large_binary()), b.column("firsts"), b.column("counts"), strict=True):
            raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
            first = firsts.values.to_numpy()
            step = np.zeros(len(raw) + 1, dtype=np.int64)
            np.add.at(step, first, 1)
            np.subtract.at(step, first + counts.values.to_numpy() + window - 1, 1)
            gone = np.cumsum(step[:-1]) > 0
            n_bytes.append(len(raw))
            n_removed.append(int(gone.sum()))
            n_spans.append(int((np.diff(gone.view(np.int8), prepend=0) == 1).sum()))
            kept.append(raw[~gone].tobytes())
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the bytes that are left) for every row."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/radix-dedup-{uuid.uuid4().hex}"
    # Equal rows report the same span, each for itself.
    (repeated_spans(docs, window).groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"))
     .agg(F.collect_list("first").alias("firsts"), F.collect_list("n").alias("counts")).write.parquet(path))
    spans = spark.read.parquet(path)
    rows, match = _keyed(docs), (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    ids = spans.select("_doc", "_mark")
    if spans.count() <= BROADCAST_IDS:
        # Only texts that lose bytes are shuffled.
        some, others = rows.join(F.broadcast(ids), match, "left_semi").join(spans, match), rows.join(F.broadcast(ids), match, "left_anti")
    else:
        both = rows.join(spans, match, "left")
        some, others = both.filter("firsts is not null"), both.filter("firsts is null")
    changed = some.select("doc_id", "text", "firsts", "counts").mapInArrow(
        lambda it: _finish(it, window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    whole = others.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
                          F.encode(text, "UTF-8").alias("kept"))
    return changed.unionByName(whole)
