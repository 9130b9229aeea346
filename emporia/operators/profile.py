"""Profiling: row counts, null counts, clean-vs-raw reconciliation, statistics.

Each report is one aggregation pass per table (not one job per column) and
returns a small DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.columns import avg_of, pct_of, round_half_up

TOTAL_LABEL = "TOTAL"


def _q(name: str) -> F.Column:
    return F.col(f"`{name}`")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table plus a grand total row."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    return with_total(reduce(DataFrame.unionByName, parts))


def with_total(counts: DataFrame) -> DataFrame:
    """(table_name, row_count) with a grand total row."""
    return (counts.rollup("table_name").agg(F.sum("row_count").alias("row_count"))
            .select(F.coalesce("table_name", F.lit(TOTAL_LABEL)).alias("table_name"), "row_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and the null count of every column."""
    return df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(_q(c).isNull()).alias(c) for c in df.columns])


def null_profile(df: DataFrame, name: str, only_with_nulls: bool = True) -> DataFrame:
    """(table, column, null count, share of rows in %) for each column."""
    wide = null_counts(df)
    long = wide.unpivot(["_rows"], [_q(c) for c in df.columns], "column_name", "null_count")
    return null_shares(long.withColumn("table_name", F.lit(name)), only_with_nulls)


def null_shares(counts: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """``null_profile`` from (table_name, column_name, null_count, _rows)."""
    out = counts.select("table_name", "column_name", F.col("null_count").cast("bigint").alias("null_count"),
                        pct_of(F.col("null_count"), F.col("_rows"), 1).alias("null_pct"))
    return out.filter(F.col("null_count") > 0) if only_with_nulls else out


def null_total(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, total nulls over all columns) after cleaning."""
    wide = null_counts(df)
    total = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0)
    return wide.select(F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"),
                       total.cast("bigint").alias("total_nulls"))


def clean_report(raw: DataFrame, clean: DataFrame, name: str) -> DataFrame:
    """Raw rows, clean rows, dropped rows and dropped share for one table.

    Both counts come from one aggregation over the tagged union of the two
    inputs, so no join of the two results is needed.
    """
    tagged = (raw.select(F.lit(1).alias("_raw"), F.lit(0).alias("_clean"))
              .unionByName(clean.select(F.lit(0).alias("_raw"), F.lit(1).alias("_clean"))))
    n = tagged.agg(F.sum("_raw").cast("bigint").alias("raw_rows"), F.sum("_clean").cast("bigint").alias("clean_rows"))
    return dropped_shares(n.withColumn("table_name", F.lit(name)))


def dropped_shares(counts: DataFrame) -> DataFrame:
    """``clean_report`` from (table_name, raw_rows, clean_rows)."""
    dropped = F.col("raw_rows") - F.col("clean_rows")
    return counts.select("table_name", "raw_rows", "clean_rows", dropped.alias("dropped_rows"),
                         pct_of(dropped, F.col("raw_rows"), 2).alias("dropped_pct"))


def describe(df: DataFrame, columns: list[str], digits: int = 6, quartiles: bool = False,
             accuracy: int = 10_000) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column, one row each.

    Statistics are doubles rounded to ``digits`` places; one pass computes all
    columns. ``quartiles=True`` adds approximate 25/50/75 % points from a
    bounded-memory sketch in the same pass (as ``DataFrame.summary`` does).
    """
    aggs = []
    for c in columns:
        x = _q(c).cast("double")
        aggs += [F.count(_q(c)).alias(f"{c}__count"), avg_of(_q(c)).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if quartiles:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    rows = []
    for c in columns:
        fields = [F.lit(c).alias("column_name"),
                  F.col(f"`{c}__count`").alias("count"),
                  round_half_up(F.col(f"`{c}__mean`"), digits).alias("mean"),
                  round_half_up(F.col(f"`{c}__stddev`"), digits).alias("stddev"),
                  F.col(f"`{c}__min`").alias("min"),
                  F.col(f"`{c}__max`").alias("max")]
        if quartiles:
            fields += [F.col(f"`{c}__q`")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
        rows.append(F.struct(*fields))
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value and their share in %."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())  # over the few label rows only
    return counts.select(F.col(label).alias("label"), "row_count", pct_of(F.col("row_count"), total, 2).alias("share_pct"))
