"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it holds at most this many rows.
DEFAULT_BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it is cheap on a large
    table. Above the bound the plain DataFrame is returned and the planner
    falls back to a shuffle join (with AQE re-planning at run time).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise if any key occurs twice; returns ``df`` unchanged otherwise.

    Used on dimension tables whose key must be unique before a left join, so
    a duplicate key cannot multiply fact rows.
    """
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"key {keys} is not unique")
    return df


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Left join a dimension on a key with different names, dropping the dim key.

    The dimension key must be unique (one row per key), so the fact side keeps
    its row count. With ``max_broadcast_rows`` the dimension is broadcast when
    a row count confirms it is small. Without it (the default for derived
    dimensions, whose count would cost a pass of its own) the choice is left
    to adaptive execution, which measures the shuffled dimension at run time
    and switches to a broadcast join only under its size threshold; otherwise
    the sort-merge join stays, and skewed fact partitions are split.
    """
    side = dim if max_broadcast_rows is None else broadcast_if_small(dim, max_broadcast_rows)
    return fact.join(side, fact[fact_key] == side[dim_key], "left").drop(side[dim_key])


def hot_keys(fact: DataFrame, key: str, max_hot: int = 64, min_rows: int = 1_000_000) -> list:
    """Keys holding more than max(min_rows, rows / max_hot) fact rows.

    At most ``max_hot`` keys can pass the share bound, so the list (and any
    dimension rows looked up for it) has a proven size. Counting is an
    aggregation with a map-side partial step.
    """
    total = fact.count()
    threshold = max(min_rows, total // max_hot)
    counts = (fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > threshold))
    return [r[0] for r in counts.select(key).collect()]


def left_lookup_split(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                      max_hot: int = 64, min_rows: int = 1_000_000) -> DataFrame:
    """``left_lookup`` that sends hot fact keys through a broadcast join.

    Fact rows whose key is hot (see ``hot_keys``) join the few matching
    dimension rows by broadcast, so no shuffle partition receives a hot key;
    rows with a null key cannot match and skip the join (shuffling them would
    put them all in one partition); the rest use the ordinary shuffle join.
    Same rows as ``left_lookup``.
    """
    hot = hot_keys(fact, fact_key, max_hot, min_rows)
    key = F.col(fact_key)
    dim_cols = [f for f in dim.schema.fields if f.name != dim_key]
    no_key = fact.filter(key.isNull()).withColumns({f.name: F.lit(None).cast(f.dataType) for f in dim_cols})
    if hot:
        is_hot = key.isin(hot)
        dim_hot = F.broadcast(dim.filter(F.col(dim_key).isin(hot)))   # one row per hot key at most
        hot_part = (fact.filter(is_hot).join(dim_hot, fact[fact_key] == dim_hot[dim_key], "left")
                    .drop(dim_hot[dim_key]))
        cold = fact.filter(key.isNotNull() & ~is_hot)
    else:
        hot_part, cold = None, fact.filter(key.isNotNull())
    cold_part = cold.join(dim, cold[fact_key] == dim[dim_key], "left").drop(dim[dim_key])
    out = cold_part.unionByName(no_key)
    return out if hot_part is None else out.unionByName(hot_part)
