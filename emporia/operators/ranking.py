"""Exact ntiles and quantiles of a whole table without a one-task sort.

``ntile(k).over(Window.orderBy(x))`` and ``percentile_disc`` move every row
into one task. Neither needs a rank per row: an ntile is fixed by the k - 1
keys at which a new bucket begins, a quantile by one key. ``keys_at`` finds
the keys at given positions by narrowing: a bounded sample of the range that
holds a position gives up to three cut keys around it, one aggregation counts
the rows below and at each cut, and the range shrinks to the part that holds
the position (or to a cut itself, however often that key occurs). A range of
at most ``rows_in_task`` rows is ordered in one task. The sample only steers
the search; the result is exact whatever it holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

ROWS_IN_TASK = 1 << 18      # rows of a range that one task may order
SAMPLE_ROWS = 1 << 11       # sampled keys per range and level (rows on the driver)
SEED = 42


def sort_key(df: DataFrame, order: list[tuple[str, bool]]) -> Column:
    """Struct whose ascending order is the requested order.

    ``order`` lists (column, ascending). A descending column must be numeric
    and is negated; nulls sort first in ascending position.
    """
    fields = []
    for i, (name, asc) in enumerate(order):
        c = F.col(f"`{name}`")
        if not asc:
            if not isinstance(df.schema[name].dataType, NumericType):
                raise ValueError(f"descending order on non-numeric column {name}")
            c = -c
        fields.append(c.alias(f"k{i}"))
    return F.struct(*fields)


def _literal(row, struct_type) -> Column:
    return F.struct(*[F.lit(row[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(struct_type.fields)])


def _spark_order(row) -> tuple:
    """Python sort key agreeing with Spark's ascending struct order.

    Nulls first, NaN above every number; strings compare by code point, which
    is the byte order of UTF-8 that Spark uses.
    """
    out = []
    for v in row:
        if v is None:
            out.append((0, 0))
        elif isinstance(v, float) and math.isnan(v):
            out.append((2, 0))
        else:
            out.append((1, v))
    return tuple(out)


@dataclass
class _Search:
    """One position of one order: the open range (lo, hi) of keys that holds it."""

    order: str
    position: int
    size: int                       # rows in the range
    before: int = 0                 # rows in front of the range
    lo: tuple | None = None
    hi: tuple | None = None
    cuts: list = field(default_factory=list)
    found: tuple | None = None

    @property
    def place(self) -> tuple:
        return self.order, self.lo, self.hi


class _Keys:
    """The sort keys of a table as columns ``_k_<order>``, and conditions on them."""

    def __init__(self, df: DataFrame, orders: dict[str, list[tuple[str, bool]]]):
        self.df = df.select(*[sort_key(df, o).alias(f"_k_{n}") for n, o in orders.items()])

    def col(self, name: str) -> Column:
        return F.col(f"_k_{name}")

    def lit(self, name: str, key: tuple) -> Column:
        return _literal(key, self.df.schema[f"_k_{name}"].dataType)

    def inside(self, place: tuple) -> Column:
        name, lo, hi = place
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (self.col(name) > self.lit(name, lo))
        if hi is not None:
            ok = ok & (self.col(name) < self.lit(name, hi))
        return ok

    def rows(self, places: list[tuple], rates: list[float] | None = None, seed: int = SEED) -> DataFrame:
        """Rows (place number, and the key as column of its order) of ranges of any orders in one pass; sampled, if rates are given."""
        names = [n.removeprefix("_k_") for n in self.df.columns]
        types = {n: self.df.schema[f"_k_{n}"].dataType for n in names}
        flags = []
        for i, place in enumerate(places):
            wanted = self.inside(place)
            if rates is not None and rates[i] < 1:
                wanted = wanted & (F.rand(seed + i) < rates[i])
            keys = [(self.col(n) if n == place[0] else F.lit(None).cast(types[n])).alias(n) for n in names]
            flags.append(F.when(wanted, F.struct(F.lit(i).alias("place"), *keys)))
        return self.df.select(F.explode(F.array_compact(F.array(*flags))).alias("r")).select("r.*")


def keys_at(df: DataFrame, orders: dict[str, list[tuple[str, bool]]], positions: dict[str, list[int]], n: int,
            rows_in_task: int = ROWS_IN_TASK, sample_rows: int = SAMPLE_ROWS) -> dict[str, list[tuple]]:
    """The sort keys at 0-based ``positions`` of each order over the ``n`` rows of ``df``.

    All positions of all orders share each sampling and each counting pass. An
    order whose key is not unique is fine: equal keys are the same answer.
    """
    keys = _Keys(df, orders)
    searches = [_Search(name, p, n) for name in orders for p in positions[name]]
    level = 0
    while open_ := [s for s in searches if s.found is None and s.size > rows_in_task]:
        level += 1
        places = _places(open_)
        rates = [sample_rows / next(s.size for s in open_ if s.place == p) for p in places]
        sample = keys.rows(places, rates, SEED + level * len(searches)).collect()
        for s in open_:
            own = sorted((tuple(r[s.order]) for r in sample if places[r.place] == s.place), key=_spark_order)
            s.cuts = _cuts(own, (s.position - s.before) / s.size)
        _narrow(keys, open_)
    if rest := [s for s in searches if s.found is None]:
        places = _places(rest)
        # Of a place's rows only the key of its order is not null.
        ranked = keys.rows(places).withColumn(
            "pos", F.row_number().over(Window.partitionBy("place").orderBy(*[F.col(f"`{name}`") for name in orders])) - 1)
        wanted = F.struct("place", "pos").isin([F.struct(F.lit(places.index(s.place)), F.lit(s.position - s.before)) for s in rest])
        found = {(r.place, r.pos): r for r in ranked.filter(wanted).collect()}
        for s in rest:
            s.found = tuple(found[places.index(s.place), s.position - s.before][s.order])
    return {name: [s.found for s in searches if s.order == name] for name in orders}


def _places(searches: list[_Search]) -> list[tuple]:
    """The distinct ranges."""
    return list(dict.fromkeys(s.place for s in searches))


def _cuts(sample: list[tuple], share: float) -> list[tuple]:
    """Up to three sampled keys: near the wanted share, and about four deviations on either side."""
    if not sample:
        return []
    m = len(sample)
    at = min(m - 1, int(share * m))
    margin = int(4 * math.sqrt(m * share * (1 - share))) + 2
    near = [sample[i] for i in (at - margin, at, at + margin) if 0 <= i < m]
    return sorted(set(near), key=_spark_order)


def _narrow(keys: _Keys, searches: list[_Search]) -> None:
    """Count the rows below and at each cut, and shrink each range to the part that holds the position."""
    counts = []
    for i, s in enumerate(searches):
        for j, cut in enumerate(s.cuts):
            c, k = keys.lit(s.order, cut), keys.col(s.order)
            counts += [F.count_if(k < c).alias(f"b_{i}_{j}"), F.count_if(k == c).alias(f"e_{i}_{j}")]
    if not counts:
        return
    row = keys.df.agg(*counts).first()
    for i, s in enumerate(searches):
        lo, hi, start, end = s.lo, s.hi, s.before, s.before + s.size
        for j, cut in enumerate(s.cuts):
            below, equal = row[f"b_{i}_{j}"], row[f"e_{i}_{j}"]
            if s.position < below:
                hi, end = cut, below
                break
            if s.position < below + equal:
                s.found = cut
                break
            lo, start = cut, below + equal
        s.lo, s.hi, s.before, s.size = lo, hi, start, end - start


def bucket_starts(n: int, k: int) -> list[int]:
    """0-based positions at which the buckets 2..k of NTILE(k) over n rows begin."""
    base, rem = divmod(n, k)
    starts = [j * base + min(j, rem) for j in range(1, k)]
    return [p for p in starts if p < n]


def global_ntiles(df: DataFrame, orders: dict[str, list[tuple[str, bool]]], k: int,
                  rows_in_task: int = ROWS_IN_TASK, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Several exact ``ntile(k)`` columns over the whole table, one per named order.

    Each order must be total (end it with a unique key). Rows are scored by
    comparing their key with the k - 1 boundary keys: one projection, no
    window and no exchange over the rows.
    """
    n = df.count()
    starts = bucket_starts(n, k)
    found = keys_at(df, orders, dict.fromkeys(orders, starts), n, rows_in_task, sample_rows) if starts else {}
    scores = {}
    for name, order in orders.items():
        key = sort_key(df, order)
        fields = df.select(key.alias("k")).schema["k"].dataType
        reached = [(key >= _literal(cut, fields)).cast("int") for cut in found.get(name, [])]
        scores[name] = sum(reached, F.lit(1)).cast("int")
    return df.withColumns(scores)


def exact_quantile(df: DataFrame, column: str, q: float, rows_in_task: int = ROWS_IN_TASK,
                   sample_rows: int = SAMPLE_ROWS):
    """Smallest value whose cumulative share reaches q (``percentile_disc``), nulls ignored.

    The value at 1-based position ceil(q * n) in ascending order; None when
    there is no non-null value.
    """
    return exact_quantiles(df, [column], q, rows_in_task, sample_rows)[column]


def exact_quantiles(df: DataFrame, columns: list[str], q: float, rows_in_task: int = ROWS_IN_TASK,
                    sample_rows: int = SAMPLE_ROWS) -> dict:
    """``exact_quantile`` of several columns in one search: all share its passes."""
    names = {f"v{i}": c for i, c in enumerate(columns)}
    data = df.select(*[F.col(f"`{c}`").alias(v) for v, c in names.items()])
    known = data.agg(F.count(F.lit(1)).alias("n"), *[F.count(v).alias(v) for v in names]).first()
    # Nulls come first in ascending order.
    positions = {v: [known.n - known[v] + min(known[v], max(1, math.ceil(q * known[v]))) - 1] for v in names if known[v]}
    orders = {v: [(v, True)] for v in positions}
    found = keys_at(data, orders, positions, known.n, rows_in_task, sample_rows) if orders else {}
    return {c: found[v][0][0] if v in found else None for v, c in names.items()}
