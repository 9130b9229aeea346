"""De-duplication by key with a total order, as aggregations.

``dropDuplicates`` keeps an arbitrary row and a ``row_number`` window sends
every row of a key to one task. Both are replaced by a ``min``/``max`` over a
struct whose leading fields are the ordering columns: the result is fixed by
the data alone, and the aggregate is combined map-side, so a key holding a
large share of all rows is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _packed(df: DataFrame, keys: list[str], order_by: list[str]) -> list[str]:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return [*order_by, *rest]


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None, count: str | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` then the other columns.

    Nulls in ordering columns sort first. Rows equal in every column are
    interchangeable, so the result does not depend on partitioning. ``count``
    names a further column with the number of rows that were merged.
    """
    fields = _packed(df, keys, [c for c in (order_by or []) if c not in keys])
    row = [F.min(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("_row")]
    more = [count] if count else []
    row += [F.count(F.lit(1)).alias(c) for c in more]
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*row)
            .select(*[F.col(f"`{c}`") for c in keys], *[F.col("_row").getField(c).alias(c) for c in fields], *more)
            .select(*[F.col(f"`{c}`") for c in df.columns], *more))


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """One row per ``key``: the latest ``ts``, ties to the greatest ``tiebreak``.

    A null ``ts`` is older than any date, so it wins only when every row of
    the key lacks a date (``ORDER BY ts DESC NULLS LAST`` semantics).
    """
    fields = _packed(df, [key], [ts, tiebreak])
    row = F.max(F.struct(*[F.col(c) for c in fields])).alias("_row")
    return (df.groupBy(key).agg(row)
            .select(key, *[F.col("_row").getField(c).alias(c) for c in fields])
            .select(*df.columns))


def distinct_rows(df: DataFrame, count: str | None = None) -> DataFrame:
    """Whole-row de-duplication (hash aggregate, combined map-side); ``count`` as in ``dedup_by_key``."""
    if count is None:
        return df.distinct()
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(count))
