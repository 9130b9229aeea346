"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct word n-grams, as 64-bit hashes. The global
n-gram order is cut into fragments; a pair's overlap is counted fragment by
fragment, each count on its own, and summed per pair. Pairs with
100 * intersection >= threshold * union link their documents, and linked
documents form components.

Global order: n-grams by hash, the frequent ones (found in a sample of the
documents) behind all others. Any order gives the same links; this one keeps
the frequent n-grams out of most prefixes. Two sets can link only if their
prefixes under the order share an n-gram, so documents meet in the blocks of
their prefix n-grams.

No group is expanded into all its pairs. Equal sets are one node from the
start. A first round links each node to the nearest hub of its blocks, a second to
its nearest partner in another component; nodes in one component then need no
further test. What is left, pairs from different components within a block,
is tested in a third. The last two work in tiles of bounded size: a block is
cut by a hash into parts, and every two parts meet in a tile of their own. An
upper bound of the overlap (the smaller of the two counts in each narrow
fragment, summed) is taken before a pair leaves its tile, and one from finer
counts before sets are fetched, so few pairs far from the threshold are
emitted, and every pair that can link is.

Defined results: a null or empty text has an empty set and is linked with
nothing; a text of fewer words than an n-gram has one n-gram, all its words;
a document without an id is linked with nothing and has no component; rows
that repeat an id are separate texts whose component ids are minima over ids;
only ``doc_id`` and ``text`` are read; an empty table gives an empty table.
Texts of any length are taken whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import words
from emporia.operators.joins import broadcast_if_small
from emporia.plans.session import ensure_checkpoint_dir

NARROW = 128              # narrow fragments, for the bound; a count takes four bits
FRAGMENTS = 4             # fragments in which overlaps are counted
TILE = 512                # nodes in a part of a block
SMALL = 16                # tiles up to this size are compared together
SAMPLE = 16               # one document in SAMPLE is looked at for frequent n-grams
SAMPLE_COUNT = 8          # an n-gram in so many sampled documents is frequent
FREQUENT = 1 << 18        # at most so many, the most frequent ones: 2 MB to broadcast
HOT_BLOCK = 1 << 16       # a block of so many nodes is counted with partial sums
BROADCAST_NODES = 1 << 20
BEST_BLOCKS = 8           # one block in so many is looked at for nearest partners
_FULL = 15                # a count that may be larger


@dataclass(frozen=True)
class Similarity:
    """n-gram length in words, and the Jaccard threshold in percent."""

    n: int = 4
    percent: int = 85


def text_sets(w: words.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct n-gram hashes of each text."""
    h = w.hashes()
    at, grams = w.windows(h, n)
    owner = np.searchsorted(w.first, at, "right") - 1
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for j, p in enumerate(words.powers(n)):
            has = w.counts[short] > j
            whole[has] += h[w.first[short[has]] + j] * p
        whole = words.mix(whole + w.counts[short].astype(np.uint64))
        owner, grams = np.concatenate([owner, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    owner, grams = owner[new], grams[new]
    return grams, np.searchsorted(owner, np.arange(len(w.counts) + 1))


def _longs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values.view(np.int64))).cast(
        pa.list_(pa.int64()))


def _node(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each set; empty sets have none (masked)."""
    n = np.diff(offsets)
    total = np.concatenate(([np.uint64(0)], np.cumsum(words.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    return words.mix(total[offsets[1:]] - total[offsets[:-1]] + n.astype(np.uint64)).view(np.int64)


def _packed(counts: np.ndarray) -> np.ndarray:
    """Counts below 16, two to a byte."""
    return counts[:, ::2] | (counts[:, 1::2] << 4)


def _counts(column: pa.Array) -> np.ndarray:
    """The counts of a column of packed vectors, a row each."""
    packed = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, NARROW // 2)
    out = np.empty((len(packed), NARROW), dtype=np.uint8)
    out[:, ::2], out[:, 1::2] = packed & 15, packed >> 4
    return out


def _profiles(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, sim: Similarity) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        for lo, hi, w in words.chunks(b.column("text"), table=words.LOWER):
            grams, offsets = text_sets(w, sim.n)
            n = np.diff(offsets)
            owner = np.repeat(np.arange(hi - lo), n)
            narrow = (grams >> np.uint64(57)).astype(np.int64)
            counts = np.bincount(owner * NARROW + narrow, minlength=(hi - lo) * NARROW)
            vectors = _packed(np.minimum(counts, _FULL).astype(np.uint8).reshape(-1, NARROW))
            size = n - -(-sim.percent * n // 100) + 1
            size[n == 0] = 0
            rare = np.searchsorted(frequent, grams, "left") == np.searchsorted(frequent, grams, "right")
            order = np.lexsort((grams, ~rare, owner))
            first = np.arange(len(grams)) - np.repeat(offsets[:-1], n) < np.repeat(size, n)
            yield pa.RecordBatch.from_pydict({
                "n": pa.array(n, pa.int64()),
                "node": pa.array(_node(grams, offsets), pa.int64(), mask=n == 0),
                "vector": pa.array([v.tobytes() for v in vectors], pa.binary()),
                "prefix": _longs(grams[order][first], np.concatenate(([0], np.cumsum(size))))})


def _node_rows(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        for lo, hi, w in words.chunks(b.column("text"), table=words.LOWER):
            grams, offsets = text_sets(w, sim.n)
            n = np.diff(offsets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").slice(lo, hi - lo), "mark": b.column("mark").slice(lo, hi - lo),
                "n": pa.array(n, pa.int64()), "node": pa.array(_node(grams, offsets), pa.int64(), mask=n == 0)})


def _sample_grams(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in words.freed(batches):
        for _, _, w in words.chunks(b.column("text"), table=words.LOWER):
            grams, _ = text_sets(w, n)
            yield pa.RecordBatch.from_pydict({"g": pa.array(grams.view(np.int64))})


def frequent_grams(docs: DataFrame, sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of n-grams that are frequent in a sample, and of those that fill more than ``HOT_BLOCK``; a bounded number."""
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(lambda it: _sample_grams(it, sim.n), "g long").groupBy("g").count()
    top = counts.filter(F.col("count") >= SAMPLE_COUNT).orderBy(F.desc("count"), "g").limit(FREQUENT)
    found = top.select("g", (F.col("count") * SAMPLE >= HOT_BLOCK).alias("hot")).collect()
    return tuple(np.sort(np.array([r.g for r in found if r.hot or not only], dtype=np.int64).view(np.uint64)) for only in (False, True))


@dataclass
class _Tiles:
    """Rows of whole tiles, and the pairs of them that can reach the threshold."""

    table: pa.Table
    percent: int

    def __post_init__(self):
        self.node, self.n, self.root, self.part = (self.table.column(c).to_numpy() for c in ("node", "n", "root", "part"))
        self.i, self.j = (self.table.column(c).to_numpy() for c in ("i", "j"))
        self.counts = _counts(self.table.column("vector"))
        self.full = (self.counts == _FULL).any(axis=1)

    def worth(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of rows from different components whose sizes are near enough."""
        n, m = self.n[a], self.n[b]
        return (self.root[a] != self.root[b]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))

    def near(self, a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Pairs whose bound reaches the threshold; a full count bounds nothing if both rows have one."""
        return ((100 + self.percent) * bound >= self.percent * (self.n[a] + self.n[b])) | (self.full[a] & self.full[b])

    def listed(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple]:
        """(a, b, bound) of those pairs of rows that can reach the threshold."""
        ok = self.worth(a, b)
        a, b = a[ok], b[ok]
        for lo in range(0, len(a), 1 << 15):
            x, y = a[lo:lo + (1 << 15)], b[lo:lo + (1 << 15)]
            bound = np.minimum(self.counts[x], self.counts[y]).sum(axis=1, dtype=np.int64)
            ok = self.near(x, y, bound)
            yield x[ok], y[ok], bound[ok]

    def crossed(self, left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple]:
        """The same for every row of ``left`` with every row of ``right`` (``same``: each pair of rows once)."""
        for lo in range(0, len(left), 32):
            part = left[lo:lo + 32]
            bound = np.minimum(self.counts[part][:, None, :], self.counts[right][None, :, :]).sum(axis=2, dtype=np.uint16)
            x, y = np.repeat(part, len(right)), np.tile(right, len(part))
            bound = bound.ravel().astype(np.int64)
            ok = self.worth(x, y) & self.near(x, y, bound)
            if same:
                ok &= x < y
            yield x[ok], y[ok], bound[ok]

    def pairs(self) -> Iterator[tuple]:
        key = np.stack([self.table.column("g").to_numpy(), self.i, self.j], axis=1)
        lo = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        size = np.diff(np.append(lo, len(key)))
        small = (size <= SMALL) & (self.i[lo] == self.j[lo])
        for s in range(2, SMALL + 1):
            first = lo[small & (size == s)]
            if len(first):
                x, y = np.triu_indices(s, 1)
                yield from self.listed((first[:, None] + x).ravel(), (first[:, None] + y).ravel())
        for at, k in zip(lo[~small].tolist(), size[~small].tolist(), strict=True):
            rows = np.arange(at, at + k)
            if (self.root[rows] == self.root[at]).all():
                continue
            i, j = self.i[at], self.j[at]
            yield from self.crossed(rows[self.part[rows] == i], rows[self.part[rows] == j], i == j)

    def batch(self, best: bool) -> pa.RecordBatch:
        """The pairs as node ids, with the share that the bound leaves them; ``best``: only each row's pair of the largest."""
        found = list(self.pairs())
        a, b, bound = (np.concatenate([f[c] for f in found]) if found else np.empty(0, dtype=np.int64) for c in range(3))
        share = bound / (self.n[a] + self.n[b])
        if best and len(a):
            row, pair = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
            order = np.lexsort((self.node[np.concatenate([b, a])], share[pair], row))
            last = np.append(row[order][1:] != row[order][:-1], True)
            pick = np.unique(pair[order][last])
            a, b, share = a[pick], b[pick], share[pick]
        p, q = self.node[a], self.node[b]
        return pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(p, q)), "b": pa.array(np.maximum(p, q)), "share": pa.array(share)})


def _tile_pairs(batches: Iterator[pa.RecordBatch], percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (g, i, j), a tile each; the last tile of a batch waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for b in words.freed(batches):
        if not b.num_rows:
            continue
        key = np.stack([b.column(c).to_numpy() for c in ("g", "i", "j")], axis=1)
        new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if rest and tuple(rest[-1].column(c)[-1].as_py() for c in ("g", "i", "j")) != tuple(key[0].tolist()):
            new = np.concatenate(([0], new))
        if len(new):
            whole = [*rest, b.slice(0, new[-1])]
            yield _Tiles(pa.Table.from_batches(whole), percent).batch(best)
            rest = []
        rest.append(b.slice(int(new[-1]) if len(new) else 0))
    if rest:
        yield _Tiles(pa.Table.from_batches(rest), percent).batch(best)


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of (a, b, na, nb, va, vb) the pairs whose bound reaches the threshold, with the share that it leaves them."""
    for b in words.freed(batches):
        if not b.num_rows:
            continue
        va, vb = _counts(b.column("va")), _counts(b.column("vb"))
        total = b.column("na").to_numpy() + b.column("nb").to_numpy()
        bound = np.minimum(va, vb).sum(axis=1, dtype=np.int64)
        full = (va == _FULL).any(axis=1) & (vb == _FULL).any(axis=1)
        ok = full | ((100 + percent) * bound >= percent * total)
        yield b.select(["a", "b"]).append_column("share", pa.array(bound / total)).filter(pa.array(ok))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(node, n, grams) of each text; texts without an n-gram are left out."""
    for b in words.freed(batches):
        for _, _, w in words.chunks(b.column("text"), table=words.LOWER):
            grams, offsets = text_sets(w, n)
            size = np.diff(offsets)
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(_node(grams, offsets)), "n": pa.array(size, pa.int64()),
                "grams": _longs(grams, offsets)}).filter(pa.array(size > 0))


def _fine_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's set as packed counts: a power of two of bins, 256 at least, with two to four n-grams in each of more."""
    for b in words.freed(batches):
        out = []
        for grams in b.column("grams"):
            g = grams.values.to_numpy().view(np.uint64)
            bits = max(8, int(len(g) - 1).bit_length() - 2)
            counts = np.bincount((g >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
            out.append(_packed(np.minimum(counts, _FULL).astype(np.uint8)[None, :])[0].tobytes())
        yield b.select(["node", "n"]).append_column("counts", pa.array(out, pa.binary()))


def _unpacked(value: pa.Scalar) -> np.ndarray:
    packed = np.frombuffer(value.as_buffer(), dtype=np.uint8)
    out = np.empty(2 * len(packed), dtype=np.int64)
    out[::2], out[1::2] = packed & 15, packed >> 4
    return out


def _fine_bounds(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs for which the smaller fine counts, summed, reach the threshold."""
    for b in words.freed(batches):
        keep = []
        for x, y, total in zip(b.column("counts_a"), b.column("counts_b"),
                               (b.column("na").to_numpy() + b.column("nb").to_numpy()).tolist(), strict=True):
            p, q = _unpacked(x), _unpacked(y)
            size = min(len(p), len(q))                    # bins are nested, so the finer ones are added up
            bound = int(np.minimum(p.reshape(size, -1).sum(axis=1), q.reshape(size, -1).sum(axis=1)).sum())
            keep.append((p == _FULL).any() or (q == _FULL).any() or (100 + percent) * bound >= percent * total)
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, grams) cut into fragments of the global order."""
    step = np.uint64((1 << 64) // FRAGMENTS)
    cuts = step * np.arange(1, FRAGMENTS, dtype=np.uint64)
    for b in words.freed(batches):
        sets = [x.values.to_numpy().view(np.uint64) for x in b.column("grams")]
        begin = np.concatenate(([0], np.cumsum([len(g) for g in sets])))
        edges = [at + np.concatenate(([0], np.searchsorted(g, cuts))) for at, g in zip(begin.tolist(), sets, strict=False)]
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(np.repeat(b.column("node").to_numpy(), FRAGMENTS)),
            "n": pa.array(np.repeat(b.column("n").to_numpy(), FRAGMENTS)),
            "fragment": pa.array(np.tile(np.arange(FRAGMENTS), len(sets)), pa.int32()),
            "grams": _longs(np.concatenate([*sets, np.empty(0, dtype=np.uint64)]), np.append(np.concatenate([*edges, []]), begin[-1])
                            .astype(np.int64))})


PROFILE = "doc_id long, mark long, n long, node long"


class _Work:
    """The tables of one join, kept in the checkpoint folder."""

    def __init__(self, spark: SparkSession, docs: DataFrame, sim: Similarity):
        self.spark, self.sim = spark, sim
        self.folder = f"{ensure_checkpoint_dir(spark)}/ngram-join-{uuid.uuid4().hex}"
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                _mark(docs).alias("mark"))

    def saved(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of distinct candidate pairs (a, b) those that link: partial overlaps by fragment, summed per pair."""
        sim = self.sim
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        first = self.profile.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        wanted = first.join(broadcast_if_small(ids, BROADCAST_NODES), "node", "left_semi").select("doc_id").distinct()
        texts = self.docs.join(broadcast_if_small(wanted, BROADCAST_NODES), "doc_id", "left_semi").select("text")
        # One text for each set, unless rows repeat an id.
        sets = texts.mapInArrow(lambda it: _sets(it, sim.n), "node long, n long, grams array<long>")
        sets = self.saved(sets.dropDuplicates(["node"]) if self.repeated else sets, f"{name}-sets")
        # A bound from fine counts first, so that few pairs need the sets themselves.
        counts = self.saved(sets.mapInArrow(_fine_counts, "node long, n long, counts binary"), f"{name}-counts")
        left, right = (counts.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("counts").alias(f"counts_{x}"))
                       for x in ("a", "b"))
        near = self.saved(pairs.join(left, "a").join(right, "b")
                          .mapInArrow(lambda it: _fine_bounds(it, sim.percent), "a long, b long"), f"{name}-near")
        ids = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        parts = (sets.join(broadcast_if_small(ids, BROADCAST_NODES), "node", "left_semi")
                 .mapInArrow(_fragments, "node long, n long, fragment int, grams array<long>"))
        left, right = (parts.select(F.col("node").alias(x), "fragment", F.col("n").alias(f"n{x}"), F.col("grams").alias(f"grams_{x}"))
                       for x in ("a", "b"))
        partial = near.join(left, "a").join(right, ["b", "fragment"]).select(
            "a", "b", "na", "nb", F.size(F.array_intersect("grams_a", "grams_b")).alias("common"))
        common = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.max("na").alias("na"), F.max("nb").alias("nb"))
        return self.saved(common.filter((100 + sim.percent) * F.col("common") >= sim.percent * (F.col("na") + F.col("nb")))
                          .select("a", "b"), f"{name}-links")

    def components(self, links: DataFrame, name: str) -> DataFrame:
        """(node, root) of all linked nodes; smallest labels spread along the links, with pointer jumping."""
        both = self.saved(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-both")
        labels = self.saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")),
                            f"{name}-0")
        turn = 0
        while True:
            turn += 1
            spread = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near")))
            step = labels.join(spread, labels["node"] == spread["a"]).select(
                "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
            jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
            step = step.join(jump, F.col("root") == F.col("via")).select("node", "old", F.least("root", "far").alias("root"))
            step = self.saved(step, f"{name}-{turn}")
            labels = step.select("node", "root")
            if step.filter("old <> root").isEmpty():
                return labels

    def nodes(self, known: DataFrame, frequent) -> DataFrame:
        """(node, n, vector, prefix) of each distinct set."""
        sim = self.sim
        least = self.profile.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
        later = (self.profile.join(least, "node").filter(F.col("doc_id") > F.col("first")).select("doc_id").distinct())
        repeated = self.profile.groupBy("doc_id").count().filter("count > 1")
        self.repeated = not repeated.isEmpty()
        if self.repeated:                             # another row of the id may be the first of its own set
            later = later.join(repeated, "doc_id", "left_anti")
        once = known.join(broadcast_if_small(later, BROADCAST_NODES), "doc_id", "left_anti")
        rows = (once.mapInArrow(lambda it: _profiles(it, frequent.value, sim), "n long, node long, vector binary, prefix array<long>")
                .filter("node is not null"))
        # Rows that repeat an id can leave a set twice.
        return rows.dropDuplicates(["node"]) if self.repeated else rows

    def blocks(self, nodes: DataFrame, hot: np.ndarray) -> DataFrame:
        """(node, n, g, m, hub): the nodes of each block of several, its size and its smallest node."""
        rows = nodes.select("node", "n", F.explode("prefix").alias("g"))
        window = "over (partition by g)"
        few = lambda df: df.withColumns({"m": F.expr(f"count(1) {window}"), "hub": F.expr(f"min(node) {window}")})
        if not len(hot):
            return few(rows).filter("m > 1")
        keys = F.broadcast(self.spark.createDataFrame([(int(g),) for g in hot.view(np.int64)], "g long"))
        many = rows.join(keys, "g", "left_semi")
        sizes = many.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("hub"))      # a row for each of ``hot``
        return few(rows.join(keys, "g", "left_anti")).unionByName(many.join(F.broadcast(sizes), "g")).filter("m > 1")

    def tiles(self, blocks: DataFrame, vectors: DataFrame, roots: DataFrame) -> DataFrame:
        """The rows of all blocks that still hold several components, sorted by tile."""
        parts = F.ceil(F.col("m") / TILE).cast("int")
        part = F.pmod(F.xxhash64("node", F.lit("tile")), parts).cast("int")
        rows = blocks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        ends = rows.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("g")
        rows = rows.join(broadcast_if_small(ends, BROADCAST_NODES), "g", "left_semi")
        rows = (rows.join(vectors.select("node", "vector"), "node")
                .select("g", "node", "n", "vector", "root", part.alias("part"),
                        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
                .select("g", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "n",
                        "vector", "root"))
        return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")

    def run(self) -> DataFrame:
        sim, spark = self.sim, self.spark
        known = self.docs.filter("doc_id is not null")
        grams, hot = frequent_grams(known, sim)
        frequent = spark.sparkContext.broadcast(grams)
        self.profile = self.saved(known.mapInArrow(lambda it: _node_rows(it, sim), PROFILE), "profile")
        nodes = self.saved(self.nodes(known, frequent), "nodes")
        blocks = self.saved(self.blocks(nodes, hot), "blocks")

        # First round: each node and the hubs of its blocks.
        vectors = nodes.select("node", "n", "vector")
        star = blocks.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        near = (star.join(vectors.toDF("a", "na", "va"), "a").join(vectors.toDF("b", "nb", "vb"), "b")
                .filter(100 * F.least("na", "nb") >= sim.percent * F.greatest("na", "nb"))
                .select("a", "b", "na", "nb", "va", "vb").mapInArrow(lambda it: _near(it, sim.percent), "a long, b long, share double"))
        # Of its hubs the nearest; what links a node to the others is found in the later rounds.
        near = near.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a")).select("a", "b")
        links = self.links(self.saved(near, "star"), "star")

        # Then, for each node and tile, its nearest partner in another component; then all that are left.
        for name, best in (("best", True), ("rest", False)):
            roots = self.components(links, f"{name}-before")
            # A nearest partner is found in a few of a node's blocks as well as in all; the last round takes all blocks.
            tiles = self.tiles(blocks.filter(F.pmod("g", F.lit(BEST_BLOCKS)) == 0) if best else blocks, vectors, roots)
            found = tiles.mapInArrow(lambda it, best=best: _tile_pairs(it, sim.percent, best), "a long, b long, share double")
            if best:
                sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
                found = (found.select(F.explode(sides).alias("s"), "share").groupBy("s.x")
                         .agg(F.max_by("s.y", F.struct("share", "s.y")).alias("y"))
                         .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
            links = links.union(self.links(self.saved(found.select("a", "b").distinct(), name), name))
        roots = self.components(links, "roots")

        self.roots = roots
        placed = self.profile.select("doc_id", "n", "node")
        some = self.placed().select("doc_id", "n", "root")
        least = some.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        linked = some.join(least, "root").select("doc_id", "n", "component_id")
        alone = placed.filter("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
        nameless = (self.docs.filter("doc_id is null").mapInArrow(lambda it: _node_rows(it, sim), PROFILE)
                    .select("doc_id", "n", F.lit(None).cast("long").alias("component_id")))
        return linked.union(alone).union(nameless).withColumnRenamed("n", "n_shingles")

    def placed(self) -> DataFrame:
        """(doc_id, mark, n, root) of every row with an id and a set."""
        return (self.profile.filter("node is not null").join(self.roots, "node", "left")
                .select("doc_id", "mark", "n", F.coalesce("root", "node").alias("root")))


def _mark(docs: DataFrame) -> Column:
    """Tells rows apart that repeat an id."""
    return F.xxhash64(docs["text"].cast("string"))


def components(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) for every row."""
    return _Work(docs.sparkSession, docs, sim).run()


def keep_one(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """One row of each component: of the smallest id, and of rows that repeat it the first by a hash of the text.

    Rows are dropped, not ids: a text whose component holds none of its id's
    other texts stays. Of rows equal in id and text one stays. Documents without
    an id or without a word stay.
    """
    work = _Work(docs.sparkSession, docs, sim)
    work.run()
    placed = work.placed()
    first = placed.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    gone = (placed.join(first, "root").filter(F.struct("doc_id", "mark") != F.col("first"))
            .select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_gone_mark")).distinct())
    gone = broadcast_if_small(gone, BROADCAST_NODES)
    kept = docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (_mark(docs) == gone["_gone_mark"]), "left_anti")
    if not work.repeated:
        return kept
    twice = (work.profile.filter("node is not null").groupBy("doc_id", "mark").count().filter("count > 1")
             .select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_gone_mark")))
    twice = broadcast_if_small(twice, BROADCAST_NODES)
    match = (kept["doc_id"] == twice["_gone"]) & (_mark(kept) == twice["_gone_mark"])
    once = kept.join(twice, match, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, match, "left_anti").unionByName(once)
