"""Benchmark decontamination by spaced-seed hashing.

A text's tokens are its lower-cased runs of letters and digits. Masks
pick some positions of each token window and ignore the others; windows of
benchmark items and of documents that agree in the picked positions of one
mask are hits, so a substituted token at an ignored position does not hide a
passage. Each hit is verified on its alignment: the best window of ``window``
tokens (the whole item if it is shorter) must agree in at least
``min_equal`` of its positions. The masks of each length are such that every
alignment which passes has a hit, so none is lost. Of hits that follow each
other on one alignment the first is verified, in one pass over its tokens. Long documents
are cut into pieces that carry as many tokens around them as the longest item
has, so a hit's row holds a piece, never a whole text.

The benchmark's seeds are broadcast in blocks of a bounded number of rows; a
larger benchmark takes more passes over the documents, each over all rows.
Verified overlaps are reduced to one row per document and item before they are
shuffled. Only DataFrame functions are used.

Defined results: a null or empty text, or an item without a token, has no
hits; a text shorter than the window that has to agree has none; equal rows give one result per document and item; items
that repeat an id with other texts are found by each of them, under that id;
null items are ignored; a document without an id is reported under null; only the
key and text columns are read; empty tables give an empty table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small

# Masks of which one fits, somewhere in 13 tokens, beside any two that differ.
SPACED = ("111010011", "110101101", "101100111", "111001011")
BLOCK_SEEDS = 1 << 19
LOOK_BACK = 16
BROADCAST_LEAKS = 1 << 20
# Tokens of a document in one row: cut in two steps, as a step reads the whole array for each of its pieces.
PIECES = (8192, 256)


def masks(length: int, others: int) -> tuple[str, ...]:
    """Masks of which one fits somewhere in ``length`` tokens beside any ``others`` that differ.

    Cut into ``others + 2`` parts, at least two parts are left whole.
    """
    if length >= 13 and others <= 2:
        return SPACED
    others = min(others, length - 1)
    k = min(others + 2, length)
    cuts = [length * i // k for i in range(k + 1)]
    return tuple("".join(("1" if i in whole else "0") * (cuts[i + 1] - cuts[i]) for i in range(k))
                 for whole in combinations(range(k), k - others))


# The fewest tokens of an item, and their masks.
SPAN = 1
MASKS = masks(SPAN, 0)


def tokens(text: Column) -> Column:
    """Hashes of a text's tokens, in order."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def least_mask(families: dict[int, tuple[str, ...]]) -> int:
    return min(len(m) for some in families.values() for m in some)


def pieces(rows: DataFrame, size: int, around: int) -> DataFrame:
    """``rows`` with their ``_own`` positions, from ``_at`` on, cut into runs of ``size``.

    Of the token hashes ``t`` each keeps its own, and ``around`` on both sides;
    ``_lo`` is the place of the first one in the document of ``_n`` tokens.
    """
    def piece(k: Column) -> Column:
        at = F.col("_at") + k
        cut = F.greatest(F.lit(0), at - around)
        return F.struct((F.col("_lo") + cut).alias("_lo"), (at - cut).alias("_at"), F.least(F.lit(size), F.col("_own") - k).alias("_own"),
                        F.slice("t", cut + 1, at - cut + size + around).alias("t"))

    cuts = F.when(F.col("_own") > 0, F.sequence(F.lit(0), F.col("_own") - 1, F.lit(size)))
    return rows.select("_key", "_n", F.explode(F.transform(cuts, piece)).alias("_piece")).select("_key", "_n", "_piece.*")


def seeds(frame: DataFrame, at: str, families: dict[int, tuple[str, ...]], own: Column | None = None,
          positions: Column | None = None) -> DataFrame:
    """One row per window and mask: ``frame`` (with token hashes ``t``) plus the position ``at`` and the hash ``h``.

    ``families`` are the masks of each length; ``own`` is the one length of a row whose masks are taken, else all are.
    Windows start at all positions, or at the ``positions`` given.
    """
    if positions is None:
        least = least_mask(families)
        frame, positions = frame.filter(F.size("t") >= least), F.sequence(F.lit(0), F.size("t") - least)
    rows = frame.withColumn(at, F.explode(positions))
    hashes = []
    for length, some in families.items():
        for i, mask in enumerate(some):
            fits = F.col(at) + len(mask) <= F.size("t")
            picked = [F.get("t", F.col(at) + o) for o, bit in enumerate(mask) if bit == "1"]
            hashes.append(F.when(fits if own is None else fits & (own == length), F.xxhash64(F.lit(length), F.lit(i), *picked)))
    return rows.withColumn("h", F.explode(F.array(*hashes))).filter("h is not null")


def _sums(equal: Column, window: Column) -> Column:
    """(sum of all elements, largest sum of ``window`` consecutive ones), in one pass."""
    gone = F.concat(F.array_repeat(F.lit(0), window), equal)          # what leaves the window at each element
    pairs = F.zip_with(equal, F.slice(gone, F.lit(1), F.size(equal)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    start = F.struct(F.lit(0).alias("all"), F.lit(0).alias("last"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        last = acc["last"] + x["a"] - x["b"]
        # Before it is full, a window holds no more than the first full one.
        return F.struct((acc["all"] + x["a"]).alias("all"), last.alias("last"), F.greatest(acc["best"], last).alias("best"))

    return F.aggregate(pairs, start, step)


def _follows(some: tuple[str, ...]) -> Column:
    """Whether windows up to ``LOOK_BACK`` tokens before a hit agree too: another hit on the same alignment."""
    def agree(mask: str, k: Column) -> Column:
        same = [F.get("t", F.col("p") - k + o) == F.get("u", F.col("q") - k + o) for o, bit in enumerate(mask) if bit == "1"]
        return reduce(lambda a, b: a & b, same)

    steps = F.sequence(F.lit(1), F.least(F.lit(LOOK_BACK), "p", "q"))
    before = F.exists(steps, lambda k: reduce(lambda a, b: a | b, [F.coalesce(agree(m, k), F.lit(False)) for m in some]))
    return (F.col("p") > 0) & (F.col("q") > 0) & before


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_equal: float = 0.8, key: str = "doc_id",
             item: str = "item_id", text: str = "text", block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """One row per document and benchmark item with a verified overlap.

    ``n_equal`` and ``best_window`` count equal tokens on the best alignment and
    in its best window; ``start_token`` and ``end_token`` bound the aligned
    tokens of the document; ``n_item`` are the tokens of the (longest) item text
    and ``whole`` says that the document is an item's text and nothing else.
    """
    bench = (benchmark.select(F.col(item).alias("_item"), tokens(F.col(text).cast("string")).alias("t"))
             .filter(F.col("_item").isNotNull() & (F.size("t") >= SPAN)).distinct().withColumn("_text", F.xxhash64("_item", "t")))
    own = F.least(F.size("t"), F.lit(window))
    lengths = sorted(r[0] for r in bench.select(own).distinct().collect()) or [window]      # at most window rows
    families = {n: masks(n, n - ceil(n * min_equal)) for n in lengths}
    rows_of = {n: (F.size("t") - len(some[0]) + 1) * len(some) for n, some in families.items()}
    total, longest = bench.agg(F.sum(F.coalesce(*[F.when(own == n, c) for n, c in rows_of.items()])), F.max(F.size("t"))).first()
    blocks = max(1, ceil((total or 0) / block_seeds))
    rows = (docs.select(F.col(key).alias("_key"), tokens(F.col(text).cast("string")).alias("t"))
            .select("_key", "t", F.size("t").alias("_n"), F.lit(0).alias("_lo"), F.lit(0).alias("_at"),
                    (F.size("t") - least_mask(families) + 1).alias("_own")))
    # No alignment of an item, and no window of a mask, takes more tokens before or after a position than the longest item has.
    for size in PIECES:
        rows = pieces(rows, size, longest or window)
    places = F.sequence("_at", F.col("_at") + F.col("_own") - 1)
    parts = []
    for b in range(blocks):
        part = bench if blocks == 1 else bench.filter(F.pmod(F.xxhash64("_text"), F.lit(blocks)) == b)
        table = F.broadcast(part.select("_item", "_text", F.col("t").alias("u")))
        wanted = F.broadcast(seeds(part, "q", families, own).select("h", "_text", "q").distinct())
        hits = seeds(rows, "p", families, positions=places).join(wanted, "h").join(table, "_text")
        # The hits of a passage follow each other; the first of each run verifies the alignment for all.
        leads = (F.size("u") < window) | ~_follows(families[window]) if window in families else F.lit(True)
        parts.append(_verified(hits, leads, window, min_equal))
    found = reduce(DataFrame.unionByName, parts)
    return (found.groupBy("_key", "_item")
            .agg(F.max("n_equal").alias("n_equal"), F.max("best_window").alias("best_window"),
                 F.min("start").alias("start_token"), F.max("end").alias("end_token"),
                 F.max("n_item").alias("n_item"), F.max("whole").alias("whole"))
            .withColumnsRenamed({"_key": key, "_item": item}))


def _verified(hits: DataFrame, leads: Column, window: int, min_equal: float) -> DataFrame:
    diagonal = F.col("p") - F.col("q")
    first = F.greatest(F.lit(0), -diagonal)
    last = F.least(F.size("u"), F.size("t") - diagonal)      # item positions on the alignment: first until last
    hits = hits.select("_key", "_item", (F.col("_lo") + first + diagonal).alias("start"), (F.col("_lo") + last + diagonal).alias("end"),
                       F.slice("t", first + diagonal + 1, last - first).alias("_doc"),
                       F.slice("u", first + 1, last - first).alias("_ref"),
                       F.least(F.lit(window), F.size("u")).alias("_window"), F.size("u").alias("n_item"),
                       ((F.col("_n") == F.size("u")) & (F.col("t") == F.col("u"))).alias("whole"), leads.alias("_leads"))
    equal = F.zip_with("_doc", "_ref", lambda a, b: (a == b).cast("int"))
    # Inside one expression, since the planner may test a filter's conditions in any order.
    sums = F.when(F.col("_leads") & (F.size("_doc") >= F.col("_window")), _sums(equal, F.col("_window")))
    hits = hits.select("_key", "_item", "start", "end", "_window", "n_item", "whole", sums.alias("_sums"))
    return (hits.select("_key", "_item", "start", "end", "_window", "n_item", "whole", F.col("_sums.all").alias("n_equal"),
                        F.col("_sums.best").alias("best_window"))
            .filter(F.col("best_window") >= F.ceil(F.col("_window") * F.lit(min_equal))))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", least_tokens: int = 13, **options) -> DataFrame:
    """The documents without those that overlap a benchmark item; all rows of a reported id go.

    An item of fewer than ``least_tokens`` tokens ("yes") is no evidence inside
    a document: it takes out only documents that are its text and nothing else.
    """
    found = overlaps(docs, benchmark, key=key, **options).filter((F.col("n_item") >= least_tokens) | F.col("whole"))
    # Texts are shuffled only if there are more leaks than can be broadcast.
    found = broadcast_if_small(found.select(F.col(key).alias("_leaked")).distinct(), BROADCAST_LEAKS)
    return docs.join(found, docs[key].eqNullSafe(found["_leaked"]), "left_anti")
