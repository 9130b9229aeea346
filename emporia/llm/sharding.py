"""Shard assignment by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards. A row descends the tree: at each level
every child draws -ln(u) / weight with u from a hash of the row's key and the
child's path, and the smallest draw wins, so a child is chosen in proportion
to its weight. A child's draw depends on nothing but key, path and weight:
when weights change, rows move only within, into or out of the subtrees whose
weights changed. A shard added as a region of its own takes rows only into
itself.

Only DataFrame functions are used. A slot (gapless from 0 in each shard) is a
row number inside a small hash bucket of the shard plus the rows of the
buckets before it, so no task sorts a whole shard.

Defined results: a null key is a key of its own (all such rows share a shard);
a null text has size 8 and checksum 0; rows repeated under one key share the
shard and get different slots, in the order of size and checksum; only the key
and text columns are read; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Tree:
    """regions -> racks -> (shard number, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> Tree:
        """Equal weights; shards are numbered in order."""
        number = iter(range(regions * racks * shards))
        return cls(tuple(tuple(tuple((next(number), 1.0) for _ in range(shards)) for _ in range(racks))
                         for _ in range(regions)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region of its own."""
        return Tree((*self.regions, (((self.shards, weight),),)))


def _choose(weights: Column, key: Column, *path: Column) -> Column:
    """Index of the child with the smallest draw below the node at ``path``; equal draws go to the earlier child."""
    def draw(weight: Column, child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, *path, child), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / weight).alias("draw"), child.alias("child"))

    return F.array_min(F.transform(weights, draw))["child"]


def _literal(value) -> Column:
    """Nested sequences as nested array literals."""
    return F.array(*map(_literal, value)) if isinstance(value, list | tuple) else F.lit(value)


def place(frame: DataFrame, tree: Tree, key: str, out: str) -> DataFrame:
    """``frame`` with the shard of each row's key as int column ``out``; one projection per level."""
    weights = [[[float(w) for _, w in rack] for rack in region] for region in tree.regions]
    racks = [[sum(rack) for rack in region] for region in weights]
    numbers = [[[n for n, _ in rack] for rack in region] for region in tree.regions]
    k, r, c = F.col(key), F.col(f"_{out}_region"), F.col(f"_{out}_rack")
    level = (frame.withColumn(f"_{out}_region", _choose(_literal([sum(x) for x in racks]), k))
             .withColumn(f"_{out}_rack", _choose(F.get(_literal(racks), r), k, r)))
    shard = _choose(F.get(F.get(_literal(weights), r), c), k, r, c)
    return (level.withColumn(out, F.get(F.get(F.get(_literal(numbers), r), c), shard).cast("int"))
            .drop(f"_{out}_region", f"_{out}_rack"))


def assign(docs: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text",
           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard for every row.

    ``size`` is the text's UTF-8 bytes plus 8; the law is ``key``: the key and
    the tree alone decide; ``grown_shard`` is the shard with one more shard in
    the tree.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = docs.count()
    buckets = max(1, ceil(n / (tree.shards * rows_per_bucket)))
    rows = place(place(docs.select(F.col(key), body.alias("_text")), tree, key, "shard"), tree.grown(), key,
                 "grown_shard")
    rows = rows.select(
        F.col(key), (F.octet_length("_text").cast("long") + 8).alias("size"), F.crc32("_text").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "grown_shard",
        F.pmod(F.xxhash64(F.col(key), F.lit("bucket")), F.lit(buckets)).cast("int").alias("_bucket"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    inside = Window.partitionBy("shard", "_bucket").orderBy(F.col(key), "size", "text_crc32")
    ranked = rows.withColumn("_at", F.row_number().over(inside) - 1)
    return (ranked.join(first, ["shard", "_bucket"])
            .select(key, "size", "text_crc32", "law", "shard", (F.col("_first") + F.col("_at")).cast("long").alias("slot"),
                    "grown_shard"))
