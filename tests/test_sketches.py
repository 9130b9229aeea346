"""Stored sketches: exact in their exact range, within the stated error beyond it."""

import pytest
from pyspark.sql import functions as F

from emporia.operators import sketches as S
from tests.conftest import rows


def _orders(spark, n, customers):
    return spark.range(n).select((2017 + F.col("id") % 2).cast("int").alias("order_year"), (F.col("id") % 12).cast("int").alias("order_month"),
                                 F.when(F.col("id") % 3 == 0, "SP").otherwise("RJ").alias("customer_state"),
                                 F.concat(F.lit("c"), (F.xxhash64("id") % customers).cast("string")).alias("customer_unique_id"),
                                 F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)).cast("double")).alias("v"))


@pytest.mark.parametrize("n,customers", [(20_000, 5_000), (300_000, 200_000)])
def test_distinct_customers_within_the_bound(spark, n, customers):
    df = _orders(spark, n, customers)
    lg = 12 if customers > 4096 else S.LG_ENTRIES
    cells = S.customer_cells(df, lg_entries=lg)
    for keys in (["order_year"], ["order_year", "customer_state"], []):
        exact = {tuple(r[k] for k in keys): r.n for r in df.groupBy(*keys).agg(F.count_distinct("customer_unique_id").alias("n")).collect()}
        for r in S.distinct_by(cells, *keys, lg_entries=lg).collect():
            assert abs(r.customers - exact[tuple(r[k] for k in keys)]) <= 4 * S.theta_error(lg) * r.customers


def test_exact_range_and_retention(spark):
    df = _orders(spark, 30_000, 8_000)
    cells = S.customer_cells(df)
    exact = df.groupBy("order_year", "customer_state").agg(F.count(F.lit(1)).alias("orders"),
                                                           F.count_distinct("customer_unique_id").alias("customers"))
    assert rows(S.distinct_by(cells, "order_year", "customer_state")) == rows(exact)
    years = {y: {r[0] for r in df.filter(F.col("order_year") == y).select("customer_unique_id").distinct().collect()} for y in (2017, 2018)}
    got = {r.order_year: (r.customers, r.retained, r.lost) for r in S.retained_by(cells, "order_year").collect()}
    assert got == {2017: (len(years[2017]), len(years[2017] & years[2018]), len(years[2017] - years[2018])),
                   2018: (len(years[2018]), 0, len(years[2018]))}


@pytest.mark.parametrize("n", [4_000, 400_000])
def test_quantile_ranks_within_the_bound(spark, n):
    df, k = _orders(spark, n, 100), 1024
    cells = S.quantile_cells(df, ("order_year", "order_month"), ["v"], k)
    values = df.filter("v IS NOT NULL").select("order_year", "v")
    for r in S.quantiles_by(cells, ["order_year"], ["v"], k=k).collect():
        own = values.filter(F.col("order_year") == r.order_year)
        assert own.count() == r.n
        for q in S.QUANTILES:
            x = r[f"p{round(100 * q)}"]
            below, upto = own.agg(F.count_if(F.col("v") < x), F.count_if(F.col("v") <= x)).first()
            assert below / r.n - S.kll_rank_error(k) <= q <= upto / r.n + S.kll_rank_error(k)


def test_caps_from_stored_sketches(spark):
    df = _orders(spark, 9_000, 100)
    cells = S.quantile_cells(df, ("order_year",), ["v"])
    ordered = sorted(r.v for r in df.filter("v IS NOT NULL").collect())
    assert S.caps(cells, ["v"], 0.99) == {"v": ordered[-(-99 * len(ordered) // 100) - 1]}


def test_empty_and_null_columns(spark):
    df = _orders(spark, 100, 10).withColumn("v", F.lit(None).cast("double"))
    assert S.quantiles_by(S.quantile_cells(df, ("order_year",), ["v"]), ["order_year"], ["v"]).count() == 0
    assert S.distinct_by(S.customer_cells(df.filter("false")), "order_year").count() == 0
