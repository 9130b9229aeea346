"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

A row's leaf is the SHA-256 of its fields. The leaves of a group (a source)
stand in the order of their keys; of every ``fanout`` consecutive nodes the
joined digests are hashed into one node, until one is left, the group's
subroot. The subroots, in the order of their groups (a null group first,
others bytewise), give the root likewise.

Coordinates come without a sort of the rows. The keys of a group are held in
compressed bitmaps, one for each 65,536 consecutive keys: the sorted low halves
of few keys, a bit for each of many, and a count for keys that repeat. Tasks
build partial bitmaps of what they read, which are merged by group and range.
How many rows stand before a bitmap is summed digit by digit over the ranges
(no window holds more than 65,536 of them); how many stand before a key inside
its bitmap is a rank query, answered from a directory of population counts.
Keys that many rows share are ranked among themselves by their leaves, in
buckets of leaf prefixes; equal rows are one entry with a count until their
slots are dealt out, in pieces.

Levels are reduced in slot arrays: the nodes of a block of ``fanout`` ** 3
slots meet by key, each is put in its slot, and three levels are hashed at
once. The sibling paths go down the same blocks. Only the root is sent to the
driver.

Defined results: a null field is marked as such and differs from an empty one;
rows without a key come first in their group; rows that repeat a key stand in
the order of their leaves, equal rows in any order; a group of one row has its
leaf as subroot, and a table of one group its subroot as root; an empty table
has no rows and no root; only the named columns are read, and carried columns
may have any other name.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small
from emporia.plans.session import ensure_checkpoint_dir

FANOUT = 16
DEPTH = 3                   # levels that are hashed in one slot array
ROWS_PER_DEAL = 1 << 16     # rows that meet in one group of a task
PIECE = 1 << 12             # slots of equal rows dealt out at once
DENSE = 1 << 12             # from so many keys on, a range is a bitmap
BROADCAST_REPEATS = 1 << 18
_NO_KEY = -(1 << 47) - 1    # the range in front of all keys
_PATH = "array<struct<left:string,right:string>>"


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its UTF-8 length, a colon and the value, or as ``-`` if it is null."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its sibling path give."""
    return F.aggregate(path, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


# -- compressed bitmaps ----------------------------------------------------------


def pack_keys(lows: np.ndarray, counts: np.ndarray) -> bytes:
    """A range's keys (sorted low halves) and how many rows each has."""
    many = counts > 1
    if len(lows) < DENSE:
        body = lows.astype("<u2").tobytes()
    else:
        bits = np.zeros(1 << 16, dtype=bool)
        bits[lows] = True
        body = np.packbits(bits, bitorder="little").tobytes()
    head = np.array([len(lows), many.sum()], dtype="<u4").tobytes()
    return head + body + lows[many].astype("<u2").tobytes() + counts[many].astype("<i8").tobytes()


@dataclass
class KeyBitmap:
    """A range's keys and the counts of those with several rows.

    Few keys are sorted low halves, many are 64-bit words with a directory of
    population counts.
    """

    few: np.ndarray | None
    words: np.ndarray | None
    repeated: np.ndarray
    counts: np.ndarray

    @classmethod
    def unpack(cls, packed: bytes) -> KeyBitmap:
        n, m = np.frombuffer(packed, "<u4", 2).tolist()
        at = 8 + (2 * n if n < DENSE else 1 << 13)
        few = np.frombuffer(packed, "<u2", n, 8).astype(np.int64) if n < DENSE else None
        words = None if n < DENSE else np.frombuffer(packed, "<u8", 1 << 10, 8)
        return cls(few, words, np.frombuffer(packed, "<u2", m, at).astype(np.int64), np.frombuffer(packed, "<i8", m, at + 2 * m))

    @cached_property
    def directory(self) -> np.ndarray:
        """Keys before each word."""
        return np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    @property
    def lows(self) -> np.ndarray:
        if self.few is not None:
            return self.few
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))

    def rank(self, lows: np.ndarray) -> np.ndarray:
        """How many rows have a smaller key."""
        if self.few is not None:
            keys = np.searchsorted(self.few, lows)
        else:
            word, bit = lows >> 6, (lows & 63).astype(np.uint64)
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            keys = self.directory[word] + np.bitwise_count(below)
        more = np.concatenate(([0], np.cumsum(self.counts - 1)))
        return keys + more[np.searchsorted(self.repeated, lows)]


def _merged(lows: np.ndarray, counts: np.ndarray) -> bytes:
    some, at = np.unique(lows, return_inverse=True)
    total = np.zeros(len(some), dtype=np.int64)
    np.add.at(total, at, counts)
    return pack_keys(some, total)


def _counted(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    bitmap = KeyBitmap.unpack(packed)
    lows = bitmap.lows
    counts = np.ones(len(lows), dtype=np.int64)
    counts[np.searchsorted(lows, bitmap.repeated)] = bitmap.counts
    return lows, counts


def _codes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, list]:
    """Numbers for the values of a column, and the values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    encoded = column.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary.to_pylist()


def _partial_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        codes, names = _codes(b.column("_group"))
        chunk, low = b.column("_chunk").to_numpy(), b.column("_low").to_numpy().astype(np.int64)
        place, at = np.unique(np.stack([codes, chunk], axis=1), axis=0, return_inverse=True)
        order = np.argsort(at.ravel(), kind="stable")
        parts = np.split(low[order], np.flatnonzero(np.diff(at.ravel()[order])) + 1)
        yield pa.RecordBatch.from_pydict({
            "_group": pa.array([names[c] for c, _ in place.tolist()]), "_chunk": pa.array(place[:, 1]),
            "_packed": pa.array([_merged(p, np.ones(len(p), dtype=np.int64)) for p in parts], pa.binary())})


def _merge_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, once, packed = [], [], []
        for parts in b.column("_parts"):
            lows, counts = zip(*(_counted(p.as_py()) for p in parts.values), strict=True)
            packed.append(_merged(np.concatenate(lows), np.concatenate(counts)))
            sizes.append(int(np.concatenate(counts).sum()))
            bitmap = KeyBitmap.unpack(packed[-1])
            once.append(len(bitmap.lows) > len(bitmap.repeated))
        yield pa.RecordBatch.from_pydict({
            "_group": b.column("_group"), "_chunk": b.column("_chunk"), "_rows": pa.array(sizes, pa.int64()),
            "_once": pa.array(once, pa.bool_()), "_packed": pa.array(packed, pa.binary())})


def _repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for g, c, before, of, packed in zip(
                *(b.column(x).to_pylist() for x in ("_group", "_chunk", "_before", "_total", "_packed")), strict=True):
            bitmap = KeyBitmap.unpack(packed)
            n = len(bitmap.repeated)
            if n:
                yield pa.RecordBatch.from_pydict({
                    "_group": pa.array([g] * n), "_chunk": pa.array([c] * n, pa.int64()), "_low": pa.array(bitmap.repeated, pa.int32()),
                    "_first": pa.array(before + bitmap.rank(bitmap.repeated), pa.int64()), "_of": pa.array([of] * n, pa.int64())})


def _slots(rows: pa.Table, index: pa.Table) -> pa.Table:
    """``rows`` with the slot of each by a rank query in its range's bitmap."""
    place = {(g, c): i for i, (g, c) in enumerate(zip(index["_group"].to_pylist(), index["_chunk"].to_pylist(), strict=True))}
    before, total = index["_before"].to_numpy(), index["_total"].to_numpy()
    codes, names = _codes(rows["_group"])
    chunk, low = rows["_chunk"].to_numpy(), rows["_low"].to_numpy().astype(np.int64)
    slot, of = np.empty(len(low), dtype=np.int64), np.empty(len(low), dtype=np.int64)
    pairs, at = np.unique(np.stack([codes, chunk], axis=1), axis=0, return_inverse=True)
    order = np.argsort(at.ravel(), kind="stable")
    own = np.split(order, np.flatnonzero(np.diff(at.ravel()[order])) + 1)
    for (code, c), mine in zip(pairs.tolist(), own, strict=True):
        i = place[names[code], c]
        slot[mine] = before[i] + KeyBitmap.unpack(index["_packed"][i].as_py()).rank(low[mine])
        of[mine] = total[i]
    out = rows.drop_columns(["_deal", "_chunk", "_low"])
    return out.append_column("_at", pa.array(slot)).append_column("_of", pa.array(of))


# -- slot arrays -----------------------------------------------------------------


def levels(nodes: list[str], of: int, fanout: int, depth: int) -> list[list[str]]:
    """The nodes and up to ``depth`` levels above them; ``of`` is the number of nodes in the whole tree's level."""
    out = [nodes]
    while of > 1 and len(out) <= depth:
        nodes = [_hash(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        of = -(-of // fanout)
        out.append(nodes)
    return out


@dataclass
class _Blocks:
    """Slot arrays of the blocks in a table of nodes (_group, _at, _of, _node)."""

    table: pa.Table
    fanout: int
    depth: int

    def __post_init__(self):
        span = self.fanout ** self.depth
        codes, names = _codes(self.table["_group"])
        at, of = self.table["_at"].to_numpy(), self.table["_of"].to_numpy()
        key, first, inverse = np.unique(np.stack([codes, at // span], axis=1), axis=0, return_index=True, return_inverse=True)
        self.keys = [(names[c], b) for c, b in key.tolist()]
        self.of = of[first]
        self.width = np.minimum(span, self.of - key[:, 1] * span)
        self.base = np.concatenate(([0], np.cumsum(self.width)))
        place = self.base[inverse.ravel()] + at - key[inverse.ravel(), 1] * span
        if self.base[-1] != len(at) or len(np.unique(place)) != len(at):
            raise ValueError("a block does not hold one node for each slot")
        self.row = np.empty(len(at), dtype=np.int64)          # row of each slot
        self.row[place] = np.arange(len(at))
        nodes = [x.hex() for x in self.table["_node"].to_pylist()]
        self.nodes = [nodes[i] for i in self.row.tolist()]

    def trees(self) -> Iterator[tuple[int, int, list[list[str]]]]:
        """(number, first slot, levels) of each block."""
        for i, of in enumerate(self.of.tolist()):
            lo, hi = int(self.base[i]), int(self.base[i + 1])
            yield i, lo, levels(self.nodes[lo:hi], of, self.fanout, self.depth)


def _reduce(nodes: pa.Table, fanout: int, depth: int) -> pa.Table:
    """Each block as the one node above it."""
    blocks = _Blocks(nodes, fanout, depth)
    top = [bytes.fromhex(tree[-1][0]) for _, _, tree in blocks.trees()]
    groups, at = zip(*blocks.keys, strict=True)
    return pa.table({"_group": pa.array(groups, pa.string()), "_at": pa.array(at, pa.int64()),
                     "_of": pa.array(-(-blocks.of // fanout ** depth), pa.int64()), "_node": pa.array(top, pa.binary())})


def _paths(nodes: pa.Table, above: pa.Table, fanout: int, depth: int) -> pa.Table:
    """``nodes`` with their sibling paths: those inside the block, then those of the node above."""
    blocks = _Blocks(nodes, fanout, depth)
    parent = {k: i for i, k in enumerate(zip(above["_group"].to_pylist(), above["_at"].to_pylist(), strict=True))}
    upper, subroot = above["_path"].to_pylist(), above["_subroot"].to_pylist()
    left, right, ends, subroots = [], [], [], []
    for i, lo, tree in blocks.trees():
        j = parent[blocks.keys[i]]
        tail_left, tail_right = [x["left"] for x in upper[j]], [x["right"] for x in upper[j]]
        for at in range(len(tree[0])):
            for level in tree[:-1]:
                run = at - at % fanout
                left.append("".join(level[run:at]))
                right.append("".join(level[at + 1:run + fanout]))
                at //= fanout
            left += tail_left
            right += tail_right
            ends.append(len(left))
        subroots += [subroot[j]] * len(tree[0])
    out = nodes.take(pa.array(blocks.row)).drop_columns(["_deal"])
    steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
    path = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), steps)
    return out.append_column("_path", path).append_column("_subroot", pa.array(subroots, pa.string()))


# -- the manifest ----------------------------------------------------------------


@dataclass
class Manifest:
    """The saved levels of a manifest, lowest first.

    ``nodes`` are those of the groups: _group, _at (slot), _of (nodes in the
    group's level), _node; the leaves have their _key and carried columns
    (``_c_`` before the name) as well. ``top`` are those above the subroots, with
    the group of each subroot as _source. ``root`` is None for an empty table.
    """

    nodes: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    carried: list[str]
    key: str
    group: str
    fanout: int
    folder: str

    def subroots(self) -> DataFrame:
        """Group and subroot, a row per group."""
        return self.top[0].select(_group_name(F.col("_source")).alias(self.group), F.lower(F.hex("_node")).alias("subroot"))

    def paths(self) -> DataFrame:
        """Per row: key, group, slot, leaf, subroot, root, path (siblings left and right, level by level), carried columns."""
        root = self.top[-1].select("_group", F.lit(0).cast("long").alias("_at"), F.expr(f"cast(array() as {_PATH})").alias("_path"),
                                   F.lit("").alias("_subroot"))
        # Saved, since a cogroup needs two sources.
        groups = self._descend(self.top, _saved(root, f"{self.folder}/path-root"), "path-top").drop("_group", "_at", "_subroot").select(
            F.col("_source").alias("_group"), F.lit(0).cast("long").alias("_at"), "_path", F.lower(F.hex("_node")).alias("_subroot"))
        rows = self._descend(self.nodes, _saved(groups, f"{self.folder}/path-groups"), "path")
        return rows.select(
            F.col("_key").alias(self.key), _group_name(F.col("_group")).alias(self.group), F.col("_at").alias("slot"),
            F.lower(F.hex("_node")).alias("leaf"), F.col("_subroot").alias("subroot"), F.lit(self.root).alias("root"),
            F.col("_path").alias("path"), *[F.col(f"_c_{c}").alias(c) for c in self.carried])

    def _descend(self, levels_: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
        """The lowest level with its paths, from those of the highest."""
        for k in reversed(range(1, len(levels_) - 1)):
            above = _saved(_down(levels_[k], above, self.fanout), f"{self.folder}/{name}-{k}")
        return _down(levels_[0], above, self.fanout)


def _group_name(group: Column) -> Column:
    """The group of a bytewise ordered group key."""
    return F.when(group != "-", F.substring(group, F.lit(2), F.length(group)))


def _saved(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _dealt(frame: DataFrame, rows: int, *keys: str, size: int = ROWS_PER_DEAL) -> DataFrame:
    """``frame`` in deals by ``keys``, of about ``size`` of the ``rows`` each."""
    return frame.withColumn("_deal", F.pmod(F.xxhash64(*keys), F.lit(max(1, ceil(rows / size)))))


def _in_blocks(nodes: DataFrame, rows: int, fanout: int, size: int) -> DataFrame:
    block = F.floor(F.col("_at") / fanout ** DEPTH)
    return _dealt(nodes.withColumn("_block", block), rows, "_group", "_block", size=size).drop("_block")


def _up(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level ``DEPTH`` above ``nodes``."""
    dealt = _in_blocks(nodes.select("_group", "_at", "_of", "_node"), nodes.count(), fanout, ROWS_PER_DEAL)
    return dealt.groupBy("_deal").applyInArrow(lambda t: _reduce(t, fanout, DEPTH), "_group string, _at long, _of long, _node binary")


def _down(nodes: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with paths and subroots, from those of the nodes ``above``."""
    rows, size = nodes.count(), fanout ** DEPTH          # a path is long, so fewer rows meet at once
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    left = _in_blocks(nodes, rows, fanout, size)
    right = _dealt(above.select("_group", "_at", "_path", "_subroot"), rows, "_group", "_at", size=size)
    return left.groupBy("_deal").cogroup(right.groupBy("_deal")).applyInArrow(
        lambda n, a: _paths(n, a, fanout, DEPTH), f"{fields}, _path {_PATH}, _subroot string")


def _climb(nodes: DataFrame, most: int, fanout: int, path: str) -> list[DataFrame]:
    """All saved levels from ``nodes`` up to one node per group; ``most`` is the size of the largest group."""
    out = [nodes]
    while most > 1:
        most = ceil(most / fanout ** DEPTH)
        out.append(_saved(_up(out[-1], fanout), f"{path}-{len(out)}"))
    return out


def _with_offsets(bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with the rows before each in its group, and those of the whole group.

    A range number has 48 bits; the ranges before are summed 16 bits at a time.
    """
    counts, sums = bitmaps.select("_group", F.col("_chunk").alias("_prefix"), "_rows"), []
    for k in range(4):
        # The last prefix is -1 or 0, below the group itself.
        parent = F.shiftright("_prefix", 16) if k < 3 else F.lit(0).cast("long")
        before = Window.partitionBy("_group", "_parent").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        level = counts.withColumn("_parent", parent)
        sums.append(level.select("_group", "_prefix", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_sum")))
        counts = level.groupBy("_group", "_parent").agg(F.sum("_rows").alias("_rows")).withColumnRenamed("_parent", "_prefix")
    totals = counts.groupBy("_group").agg(F.sum("_rows").alias("_total"))
    out = bitmaps.withColumn("_before", F.lit(0).cast("long"))
    for k, level in enumerate(sums):
        out = (out.withColumn("_prefix", F.shiftright("_chunk", 16 * k)).join(level, ["_group", "_prefix"])
               .withColumn("_before", F.col("_before") + F.col("_sum")).drop("_prefix", "_sum"))
    return out.join(totals, "_group")


def _repeated_slots(rows: DataFrame, repeats: DataFrame, carried: list[str]) -> DataFrame:
    """Slots of the rows whose keys repeat: ranks by leaf, in buckets of leaf prefixes; equal rows are dealt out in pieces."""
    own = ["_group", "_key", "_of", "_first"]
    entries = (rows.join(broadcast_if_small(repeats, BROADCAST_REPEATS), ["_group", "_chunk", "_low"])
               .groupBy(*own, "_node", *carried).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_prefix", F.conv(F.hex(F.substring("_node", 1, 2)), 16, 10).cast("int")))
    in_key = Window.partitionBy(*own).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (entries.groupBy(*own, "_prefix").agg(F.sum("_n").alias("_n"))
               .select(F.struct(*own, "_prefix").alias("_place"), F.coalesce(F.sum("_n").over(in_key), F.lit(0)).alias("_bucket")))
    in_bucket = Window.partitionBy(*own, "_prefix").orderBy("_node", *carried).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(in_bucket), F.lit(0))
    placed = (entries.withColumn("_inside", before).withColumn("_place", F.struct(*own, "_prefix"))
              .join(buckets.withColumnRenamed("_place", "_place2"), F.col("_place").eqNullSafe(F.col("_place2"))))
    start, piece = F.col("_first") + F.col("_bucket") + F.col("_inside"), F.col("_piece") * PIECE
    pieces = placed.select(*own, "_node", *carried, "_n", start.alias("_start"),
                           F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / PIECE))).alias("_piece"))
    last = F.col("_start") + F.least(piece + PIECE, F.col("_n")) - 1
    return pieces.repartition("_group", "_start", "_piece").select(
        "_group", F.explode(F.sequence(F.col("_start") + piece, last)).alias("_at"), "_of", "_node", "_key", *carried)


def build(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "source", carry: list[str] | None = None,
          fanout: int = FANOUT) -> Manifest:
    """The manifest of ``docs``; leaves are hashed over ``fields``, columns named in ``carry`` go along with the leaves."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/merkle-{uuid.uuid4().hex}"
    carried = [f"_c_{c}" for c in carry or []]
    name = F.col(group).cast("string")
    number = F.col(key).cast("bigint")
    rows = _saved(docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("_group"), number.alias("_key"),
        F.unhex(leaf_hash(*map(F.col, fields))).alias("_node"), *[F.col(c[3:]).alias(c) for c in carried]), f"{folder}/rows")
    rows = rows.withColumns({"_chunk": F.coalesce(F.shiftright("_key", 16), F.lit(_NO_KEY)),
                             "_low": F.coalesce(F.col("_key").bitwiseAND(F.lit(0xFFFF)), F.lit(0)).cast("int")})

    parts = rows.select("_group", "_chunk", "_low").mapInArrow(_partial_bitmaps, "_group string, _chunk long, _packed binary")
    bitmaps = _saved(parts.groupBy("_group", "_chunk").agg(F.collect_list("_packed").alias("_parts"))
                     .mapInArrow(_merge_bitmaps, "_group string, _chunk long, _rows long, _once boolean, _packed binary"), f"{folder}/bitmaps")
    index = _saved(_with_offsets(bitmaps), f"{folder}/index")
    repeats = _saved(index.mapInArrow(_repeated_keys, "_group string, _chunk long, _low int, _first long, _of long"),
                     f"{folder}/repeats")
    some = not repeats.isEmpty()
    once = rows.join(broadcast_if_small(repeats, BROADCAST_REPEATS), ["_group", "_chunk", "_low"], "left_anti") if some else rows
    n = rows.count()
    left, right = _dealt(once, n, "_group", "_chunk"), _dealt(index.filter("_once"), n, "_group", "_chunk")
    fields_ = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("_chunk", "_low"))
    slots = left.groupBy("_deal").cogroup(right.groupBy("_deal")).applyInArrow(_slots, f"{fields_}, _at long, _of long")
    slots = slots.select("_group", "_at", "_of", "_node", "_key", *carried)
    if some:
        slots = slots.unionByName(_repeated_slots(rows, repeats, carried))
    slots = _saved(slots, f"{folder}/slots")

    most = index.agg(F.max("_total")).first()[0] or 0
    nodes = _climb(slots, most, fanout, f"{folder}/nodes")
    # Places of the groups: a range-partitioned sort, numbered by partition.
    ordered = _saved(nodes[-1].select(F.col("_group").alias("_source"), "_node").orderBy("_source")
                     .withColumn("_id", F.monotonically_increasing_id()), f"{folder}/groups")
    n_groups, part = ordered.count(), F.shiftright("_id", 33)
    parts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))          # a row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    subroots = _saved(ordered.withColumn("_part", part).join(F.broadcast(parts.select("_part", before.alias("_before"))), "_part").select(
        F.lit("").alias("_group"), place.alias("_at"), F.lit(n_groups).cast("long").alias("_of"), "_node", "_source"),
        f"{folder}/subroots")
    top = _climb(subroots, n_groups, fanout, f"{folder}/top")
    root = top[-1].select(F.lower(F.hex("_node"))).first()
    return Manifest(nodes, top, root[0] if root else None, list(carry or []), key, group, fanout, folder)
