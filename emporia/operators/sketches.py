"""Stored, mergeable sketches: distinct customers (theta) and quantiles (KLL) per month.

A month's sketches are built once; a year, a set of states or any other union
of cells is answered from the stored sketches without the orders. A theta
sketch of ``2 ** lg_entries`` entries is exact up to as many distinct values;
beyond, an estimate's relative standard error is ``1 / sqrt(2 ** lg_entries)``
(0.4 % at 16). Intersections and differences of unions estimate how many
customers two periods share: their error is that of the union, relative to it.
A KLL sketch holds a bounded sample of ranks: it is exact up to ``k`` values,
and beyond that a quantile's rank is off by about ``1.7 / k`` of the rows at
99 % confidence. Cells are aggregated map-side, so a hot state costs one
sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_ENTRIES = 16
KLL_K = 8192
QUANTILES = (0.25, 0.5, 0.75, 0.99)


def theta_error(lg_entries: int = LG_ENTRIES) -> float:
    """Relative standard error of an estimate beyond the exact range."""
    return 2 ** (-lg_entries / 2)


def kll_rank_error(k: int = KLL_K) -> float:
    """Share of the rows by which the rank of a quantile is off, at 99 % confidence."""
    return 1.7 / k


def customer_cells(mf: DataFrame, keys: tuple[str, ...] = ("order_year", "order_month", "customer_state"),
                   key: str = "customer_unique_id", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """One row per cell of ``keys``: orders, and the sketch of its distinct customers."""
    return mf.groupBy(*keys).agg(F.count(F.lit(1)).alias("orders"), F.theta_sketch_agg(key, lg_entries).alias("customers"))


def distinct_by(cells: DataFrame, *keys: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Orders and estimated distinct customers of unions of cells."""
    return cells.groupBy(*keys).agg(F.sum("orders").alias("orders"),
                                    F.theta_sketch_estimate(F.theta_union_agg("customers", lg_entries)).alias("customers"))


def retained_by(cells: DataFrame, period: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per period: estimated customers, those who come again in the next period, and those who do not.

    One row per period meets that of the next one, so the join is over the
    periods, not the customers.
    """
    unions = cells.groupBy(period).agg(F.theta_union_agg("customers", lg_entries).alias("s"))
    following = unions.select((F.col(period) - 1).alias("_p"), F.col("s").alias("t"))
    pairs = unions.join(following, F.col(period) == F.col("_p"), "left")
    none = F.lit(0).cast("long")
    estimate = F.theta_sketch_estimate
    return pairs.select(period, estimate("s").alias("customers"),
                        F.coalesce(estimate(F.theta_intersection("s", "t")), none).alias("retained"),
                        F.coalesce(estimate(F.theta_difference("s", "t")), estimate("s")).alias("lost"))


def quantile_cells(df: DataFrame, keys: tuple[str, ...], columns: list[str], k: int = KLL_K) -> DataFrame:
    """One row per cell of ``keys`` with a sketch of each column, all in one pass; nulls are left out."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), F.lit(k)).alias(c) for c in columns])


def quantiles_by(cells: DataFrame, keys: list[str], columns: list[str], q: tuple[float, ...] = QUANTILES,
                 k: int = KLL_K) -> DataFrame:
    """keys, column_name, n and p25, p50, ... of unions of cells; a column without a value has no row."""
    merged = cells.groupBy(*keys).agg(*[F.kll_merge_agg_double(F.col(f"`{c}`"), F.lit(k)).alias(c) for c in columns])
    sketches = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("s")) for c in columns])
    long = merged.select(*keys, F.explode(sketches).alias("x")).select(*keys, "x.*")
    long = long.withColumn("n", F.kll_sketch_get_n_double("s")).filter("n > 0")
    return long.select(*keys, "column_name", "n", *[_quantile(p).alias(f"p{round(100 * p)}") for p in q])


def _quantile(p: float) -> Column:
    return F.kll_sketch_get_quantile_double("s", F.lit(p))


def caps(cells: DataFrame, columns: list[str], q: float = 0.99, k: int = KLL_K) -> dict[str, float]:
    """The q-quantile of each column over all cells, from the stored sketches (one value each to the driver)."""
    found = quantiles_by(cells.withColumn("_all", F.lit(0)), ["_all"], columns, (q,), k)
    return {r.column_name: r[f"p{round(100 * q)}"] for r in found.drop("_all", "n").collect()}
