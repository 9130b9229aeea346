"""Phrase collocation mining with weighted acyclic automata.

Every word of the corpus begins one path: the word and up to three that follow
it in the same piece of text, ended by a mark where the piece ends sooner. A
count transducer holds the paths of a shard as arcs from state to state, one
layer for each word, with the counts as weights on the last; states with equal
arcs are one. The count of a phrase of one to four words is the sum of the
weights below its prefix, so shorter phrases need no paths of their own.

A task builds one transducer for each language and some megabytes of text from
the sorted paths, and cuts it where the prefix ranges meet. A range's
transducers come together in one task, where they are united with their
weights summed, a few at a time. Prefixes that lie across the ends of ranges
are summed once more; all others are final. The ranges are cut between whole
paths by a sample, which steers the work and no result, so a frequent word or
pair is split among as many ranges as it needs, and an equal path of any count
is one entry per shard.

A phrase with ``min_count`` occurrences has only parts that occur as often, so
what is kept of the counts holds all parts that are looked up. The lookup of
the parts is the composition of the candidates with the counts: an equi-join
by language and phrase.

Defined results: a null text is empty, a null language is ``und``; rows
without an id and rows that repeat one count like all others; a language whose
phrases are all rare has no row; equal scores and counts are ordered by the
phrase's bytes; only ``lang`` and ``text`` are read; an empty table gives an
empty table. Texts of any length are taken whole, in overlapping pieces.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm import words
from emporia.plans.session import ensure_checkpoint_dir

LONGEST = 4
SHARD_BYTES = 8 << 20       # text of a transducer
RANGE_BYTES = 8 << 20       # text whose paths make up a prefix range
MERGE_PATHS = 1 << 20       # paths that are united at once
SAMPLE_BYTES = 16 << 20     # text whose paths are looked at for the ranges
SAMPLE_PATHS = 1 << 16
TOP_PARTS = 32              # parts of a language that are ordered on their own first
UNKNOWN_LANG = "und"

_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK


@dataclass(frozen=True)
class Mining:
    """Least count of a phrase, share (in percent) at which a longer one covers it, and rows per language."""

    min_count: int = 30
    covered: int = 80
    top: int = 2000


# -- paths -----------------------------------------------------------------------


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, whether the next word is in the same piece, kind of each byte) of the words of consecutive texts."""
    kind = _KIND[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1])[:len(data)])
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])[:len(data)]) + 1
    breaks = np.concatenate(([0], np.cumsum(kind == _BREAK, dtype=np.int64))) + np.cumsum(edge, dtype=np.int64)
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = breaks[starts[1:]] == breaks[starts[:-1]]
    return starts, ends, joined, inside


def _shard_texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes in lower case, bounds of the texts, end): paths begin before ``end``; a long text is cut between words."""
    column = column.cast(pa.large_binary())
    buffers, n = column.buffers(), len(column)
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=n + 1, offset=column.offset * 8)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, dtype=np.uint8)
    at = 0
    while at < n:
        stop = min(max(int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES, "right")) - 1, at + 1), n)
        lo, hi = int(offsets[at]), int(offsets[stop])
        if stop > at + 1 or hi - lo <= SHARD_BYTES:
            yield words.LOWER[data[lo:hi]], offsets[at:stop + 1] - lo, hi - lo
        else:
            while lo < hi:
                end = _gap(data, min(lo + SHARD_BYTES, hi), hi)
                reach, found = end, 0
                while reach < hi and found < LONGEST:        # the words behind the cut that its paths need, and one more
                    reach = _gap(data, min(reach + 64 * LONGEST, hi), hi)
                    found = int(np.count_nonzero(np.diff((_KIND[data[end:reach]] == 0).view(np.int8), prepend=0) == 1))
                yield words.LOWER[data[lo:reach]], np.array([0, reach - lo]), end - lo
                lo = end
        at = stop


def _gap(data: np.ndarray, at: int, end: int) -> int:
    """The first byte from ``at`` on that is in no word, or the end."""
    while at < end:
        block = np.flatnonzero(_KIND[data[at:min(at + 4096, end)]])
        if len(block):
            return at + int(block[0])
        at = min(at + 4096, end)
    return end


def paths(data: np.ndarray, bounds: np.ndarray, end: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(sorted words, paths, counts): the distinct paths in order, as numbers of words from 1 on; 0 is the end mark."""
    starts, ends, joined, inside = tokens(data, bounds)
    lens = np.concatenate(([0], np.cumsum(ends - starts)))
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lens), pa.py_buffer(data[inside].copy())])
    coded = column.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    number = np.empty(len(order) + 1, dtype=np.int64)
    number[order.to_numpy()] = np.arange(1, len(order) + 1)
    ids = number[coded.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.empty(0, dtype=np.int64)
    n = int(np.searchsorted(starts, end))
    columns, on = [ids[:n]], np.ones(n, dtype=bool)
    for k in range(1, LONGEST):
        near = np.zeros(n, dtype=bool)
        near[:max(0, min(n, len(joined) - k + 1))] = joined[k - 1:k - 1 + n][:n]
        on = on & near
        following = np.zeros(n, dtype=np.int64)
        following[on] = ids[np.flatnonzero(on) + k]
        columns.append(following)
    rows, counts = summed(np.stack(columns, axis=1), np.ones(n, dtype=np.int64))
    return coded.dictionary.take(order), rows, counts


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct paths in order, with their counts summed."""
    if not len(rows):
        return rows.reshape(0, LONGEST), counts
    high, low = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))))
    return rows[order[first]], np.add.reduceat(counts[order], first)


# -- transducers -----------------------------------------------------------------


@dataclass
class Layer:
    """The states of one depth: ``size`` arcs each, with labels and targets (weights in the last layer)."""

    size: np.ndarray
    label: np.ndarray
    target: np.ndarray


def _merge_states(size: np.ndarray, label: np.ndarray, target: np.ndarray) -> tuple[Layer, np.ndarray]:
    """One state for all that have equal arcs, and the number of each state's."""
    begin = np.cumsum(size) - size
    place = np.arange(len(label)) - np.repeat(begin, size)
    arc = words.mix(words.mix(label.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))) + target.astype(np.uint64))
    key = words.mix(np.add.reduceat(arc, begin) + size.astype(np.uint64))
    _, lead, state = np.unique(key, return_index=True, return_inverse=True)
    # Equal keys are confirmed on the arcs; a state that differs stays on its own.
    of = lead[state]
    other = np.repeat(begin[of], size) + place
    same = size == size[of]
    other = np.where(np.repeat(same, size), other, np.arange(len(label)))
    differs = (label[other] != label) | (target[other] != target)
    odd = ~same | (np.add.reduceat(differs.astype(np.int64), begin) > 0)
    kept = np.union1d(lead, np.flatnonzero(odd))
    state = np.searchsorted(kept, np.where(odd, np.arange(len(size)), of))
    arcs = np.repeat(begin[kept], size[kept]) + np.arange(int(size[kept].sum())) - np.repeat(
        np.cumsum(size[kept]) - size[kept], size[kept])
    return Layer(size[kept], label[arcs], target[arcs]), state


def transducer(rows: np.ndarray, counts: np.ndarray) -> list[Layer]:
    """The layers of the minimal count transducer of sorted distinct paths, from the root on."""
    layers, target = [], counts
    for depth in reversed(range(LONGEST)):
        # Arcs are the distinct prefixes of depth + 1 words; states those of depth words.
        changed = np.ones(len(rows), dtype=bool)
        changed[1:] = (rows[1:, :depth] != rows[:-1, :depth]).any(axis=1)
        size = np.diff(np.append(np.flatnonzero(changed), len(rows)))
        layer, target = _merge_states(size, rows[:, depth], target)
        layers.append(layer)
        rows = rows[changed]
    return layers[::-1]


def spelled(layers: list[Layer]) -> tuple[np.ndarray, np.ndarray]:
    """The paths of a transducer in order, and their weights."""
    state, columns = np.zeros(1, dtype=np.int64), []
    for layer in layers:
        begin, size = np.cumsum(layer.size) - layer.size, layer.size[state]
        arc = np.repeat(begin[state], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        columns = [np.repeat(c, size) for c in columns] + [layer.label[arc]]
        state = layer.target[arc]
    return np.stack(columns, axis=1), state


def packed(vocabulary: pa.Array, layers: list[Layer]) -> bytes:
    """Words (those that the arcs name) and layers as bytes."""
    used = np.unique(np.concatenate([layer.label for layer in layers]))
    names = vocabulary.take(pa.array(used[used > 0] - 1)).to_pylist()
    used = np.union1d(used, [0])
    out = [np.array([len(names), *[x for layer in layers for x in (len(layer.size), len(layer.label))]], dtype="<i8").tobytes(),
           np.array([len(x) for x in names], dtype="<i4").tobytes()]
    for layer in layers:
        out += [layer.size.astype("<i4").tobytes(), np.searchsorted(used, layer.label).astype("<i4").tobytes(),
                layer.target.astype("<i8").tobytes()]
    return b"".join([*out, *names])


def unpacked(raw: bytes) -> tuple[list[bytes], list[Layer]]:
    head = np.frombuffer(raw, "<i8", 1 + 2 * LONGEST)
    at = head.nbytes
    lens = np.frombuffer(raw, "<i4", head[0], at)
    at += lens.nbytes
    layers = []
    for states, arcs in head[1:].reshape(-1, 2).tolist():
        size, label = np.frombuffer(raw, "<i4", states, at), np.frombuffer(raw, "<i4", arcs, at + 4 * states)
        layers.append(Layer(size.astype(np.int64), label.astype(np.int64), np.frombuffer(raw, "<i8", arcs, at + 4 * (states + arcs))))
        at += 4 * states + 12 * arcs
    ends = at + np.cumsum(lens)
    return [raw[z - k:z] for z, k in zip(ends.tolist(), lens.tolist(), strict=True)], layers


# -- shards and ranges ------------------------------------------------------------


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(language, sorted words, paths, counts) of each shard."""
    for b in words.freed(batches):
        lang = b.column("lang").dictionary_encode()
        codes = lang.indices.to_numpy(zero_copy_only=False)
        for code, name in enumerate(lang.dictionary.to_pylist()):
            for data, bounds, end in _shard_texts(b.column("text").take(pa.array(np.flatnonzero(codes == code)))):
                vocabulary, rows, counts = paths(data, bounds, end)
                if len(rows):
                    yield name, vocabulary, rows, counts


def _cut_places(cuts: list[tuple], vocabulary: pa.Array, rows: np.ndarray) -> np.ndarray:
    """How many of the paths lie before each cut (a tuple of words)."""
    names = vocabulary.to_pylist()
    high, low = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
    out = []
    for cut in cuts:
        number = []
        for word in cut:
            at = bisect.bisect_left(names, word) if word else -1
            if word and (at == len(names) or names[at] != word):
                # No path has the word: the cut lies before all that go on with the next one.
                number += [at + 1] + [0] * (LONGEST - 1 - len(number))
                break
            number.append(at + 1)
        a, b = np.searchsorted(high, [number[0] << 32 | number[1], (number[0] << 32 | number[1]) + 1])
        out.append(a + int(np.searchsorted(low[a:b], number[2] << 32 | number[3])))
    return np.array(out, dtype=np.int64)


def _shards(batches: Iterator[pa.RecordBatch], cuts: list[tuple]) -> Iterator[pa.RecordBatch]:
    codec = _codec()
    for lang, vocabulary, rows, counts in _by_lang(batches):
        name = lang.encode()
        own = slice(bisect.bisect_left(cuts, (name,)), bisect.bisect_left(cuts, (name + b"\0",)))
        edges = [0, *_cut_places([c[1:] for c in cuts[own]], vocabulary, rows).tolist(), len(rows)]
        part, size, blobs = [], [], []
        for k, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if z > a:
                raw = packed(vocabulary, transducer(rows[a:z], counts[a:z]))
                part.append(own.start + k)
                size.append(len(raw))
                blobs.append(codec.compress(raw, asbytes=True))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "lang": pa.array([lang] * len(part)), "raw_bytes": pa.array(size, pa.int64()),
            "packed": pa.array(blobs, pa.binary())})


class _Union:
    """The sum of transducers of one range."""

    def __init__(self):
        self.names: list[bytes] = []
        self.rows, self.counts = np.empty((0, LONGEST), dtype=np.int64), np.empty(0, dtype=np.int64)
        self.waiting: list[tuple[list[bytes], np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, names: list[bytes], layers: list[Layer]) -> None:
        rows, counts = spelled(layers)
        self.waiting.append((names, rows, counts))
        self.size += len(rows)
        if self.size >= MERGE_PATHS:
            self.merge()

    def merge(self) -> None:
        parts = [(self.names, self.rows, self.counts), *self.waiting]
        every = pa.array([x for names, _, _ in parts for x in names], pa.large_binary())
        coded = every.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        number = np.empty(len(order), dtype=np.int64)
        number[order.to_numpy()] = np.arange(1, len(order) + 1)
        ids, at, rows = number[coded.indices.to_numpy(zero_copy_only=False)], 0, []
        for names, own, _ in parts:
            rows.append(np.concatenate(([0], ids[at:at + len(names)]))[own])
            at += len(names)
        self.names = coded.dictionary.take(order).to_pylist()
        self.rows, self.counts = summed(np.concatenate(rows), np.concatenate([c for _, _, c in parts]))
        self.waiting, self.size = [], 0

    def phrases(self, min_count: int) -> Iterator[tuple[str, int, int]]:
        """(phrase, words, count): those that reach ``min_count``, and the first and last of each length, which other
        ranges may share; an empty phrase has the count of all words."""
        self.merge()
        if not len(self.rows):
            return
        yield "", 0, int(self.counts.sum())
        for k in range(1, LONGEST + 1):
            new = np.concatenate(([True], (self.rows[1:, :k] != self.rows[:-1, :k]).any(axis=1)))
            first = np.flatnonzero(new)
            total = np.add.reduceat(self.counts, first)
            wanted = total >= min_count
            wanted[[0, -1]] = True
            wanted &= self.rows[first, k - 1] > 0
            for row, c in zip(self.rows[first[wanted], :k].tolist(), total[wanted].tolist(), strict=True):
                yield b" ".join([self.names[i - 1] for i in row]).decode("utf-8", "replace"), k, c


def _counts(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and language."""
    codec, key, union = _codec(), None, _Union()

    def out(lang: str) -> pa.RecordBatch:
        found = list(union.phrases(min_count))
        phrase, size, count = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(found), pa.string()), "phrase": pa.array(phrase, pa.string()),
            "words": pa.array(size, pa.int32()), "f": pa.array(count, pa.int64())})

    for b in batches:
        for place, size, blob in zip(zip(b.column("part").to_pylist(), b.column("lang").to_pylist(), strict=True),
                                     b.column("raw_bytes").to_pylist(), b.column("packed"), strict=True):
            if place != key:
                if key is not None:
                    yield out(key[1])
                key, union = place, _Union()
            union.add(*unpacked(codec.decompress(blob.as_buffer(), size, asbytes=True)))
    if key is not None:
        yield out(key[1])


def _sample_paths(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    for lang, vocabulary, rows, counts in _by_lang(batches):
        at = np.arange(step // 2, int(counts.sum()), step)
        picked = rows[np.searchsorted(np.cumsum(counts), at, "right")]
        names = [b"", *vocabulary.to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang.encode()] * len(picked), pa.binary()),
            **{f"w{k}": pa.array([names[i] for i in picked[:, k].tolist()], pa.binary()) for k in range(LONGEST)}})


def range_cuts(rows: DataFrame, text_bytes: int) -> list[tuple]:
    """Sorted cuts (language and words) between prefix ranges, from a bounded sample of paths."""
    ranges = ceil(text_bytes / RANGE_BYTES)
    if ranges <= 1:
        return []
    share = min(1.0, SAMPLE_BYTES / text_bytes)
    wanted = min(SAMPLE_PATHS, 64 * ranges)
    step = max(1, int(text_bytes * share / 6 / wanted))          # a word takes some six bytes
    schema = ", ".join(["lang binary", *[f"w{k} binary" for k in range(LONGEST)]])
    sample = rows.filter(F.rand(11) < share).mapInArrow(lambda it: _sample_paths(it, step), schema)
    keys = sorted(tuple(map(bytes, r)) for r in sample.collect())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


# -- the operator ------------------------------------------------------------------


def phrase_counts(docs: DataFrame, min_count: int = Mining.min_count) -> DataFrame:
    """(lang, phrase, words, f): all phrases of up to four words with ``min_count`` occurrences, and per language an empty
    phrase with the count of all words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    cuts = range_cuts(rows, size)
    shards = rows.mapInArrow(lambda it: _shards(it, cuts), "part int, lang string, raw_bytes long, packed binary")
    partial = (words.dealt(shards, "part", 2 * size).sortWithinPartitions("part", "lang")
               .mapInArrow(lambda it: _counts(it, min_count), "lang string, phrase string, words int, f long"))
    return (partial.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
            .filter((F.col("f") >= min_count) | (F.col("words") == 0)))


def scored(counts: DataFrame, spec: Mining = Mining()) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the phrases of two and more words that no longer one covers."""
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    of = counts.filter("words > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("_f"))
    split = F.split("phrase", " ")
    found = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), split.alias("_w"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"_left": F.array_join(F.slice("_w", F.lit(1), F.col("k")), " "),
                             "_right": F.array_join(F.slice("_w", F.col("k") + 1, F.col("words")), " ")})
    for part, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(of, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))).drop("_lang", "_phrase")
        cuts = cuts.withColumnRenamed("_f", name)
    score = F.expr("cast((cast(2000000 as decimal(38,0)) * a) div (cast(l as decimal(38,0)) + r) as bigint)")
    best = (cuts.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("_cut"))
            .groupBy("lang", "phrase", "words", "a").agg(F.min("_cut").alias("_cut")))
    inner = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), "
                   "i -> array_join(slice(_w, i, n), ' '))))")
    longer = (found.filter("words > 2").select(F.col("lang").alias("_lang"), F.explode(inner).alias("_phrase"), F.col("a").alias("_f"))
              .groupBy("_lang", "_phrase").agg(F.max("_f").alias("_f")))
    kept = best.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left").filter(
        F.col("_f").isNull() | (wide("_f") * 100 < wide("a") * spec.covered))
    return kept.select("lang", "phrase", "words", "a", "_cut.l", "_cut.r", "_cut.score")


def mine(docs: DataFrame, spec: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``spec.top`` phrases."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/collocations-{uuid.uuid4().hex}"
    phrase_counts(docs, spec.min_count).write.parquet(path)
    counts = spark.read.parquet(path)
    # The first of each language are among the first of its parts, so no task orders all phrases of a language.
    rank, order = F.row_number(), (F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts, spec).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    for keys in (["lang", "_part"], ["lang"]):
        ranked = ranked.withColumn("rank", rank.over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= spec.top)
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
