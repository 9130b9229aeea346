import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators.ranking import bucket_starts, exact_quantile, global_ntiles, keys_at


def _frame(spark, n, tied_share=0.95, seed=1):
    rnd = random.Random(seed)
    data = [(f"c{i:05d}", 1 if rnd.random() < tied_share else rnd.randint(2, 50), rnd.random()) for i in range(n)]
    return spark.createDataFrame(data, "key string, freq long, money double")


@pytest.mark.parametrize("n", [3, 1000, 1003])
@pytest.mark.parametrize("asc", [True, False])
def test_global_ntiles_equal_window_ntile(spark, n, asc):
    df = _frame(spark, n)
    order = [("freq", asc), ("key", True)]
    ours = {r.key: r.q for r in global_ntiles(df, {"q": order}, 4, rows_in_task=37, sample_rows=60).collect()}
    w = Window.orderBy(F.col("freq").asc() if asc else F.col("freq").desc(), F.col("key").asc())
    ref = {r.key: r.q for r in df.withColumn("q", F.ntile(4).over(w)).collect()}
    assert ours == ref


def test_keys_at_every_position_over_many_levels(spark, monkeypatch):
    """Small samples force several levels; every position is found."""
    from emporia.operators import ranking
    levels = []
    narrow = ranking._narrow
    monkeypatch.setattr(ranking, "_narrow", lambda keys, searches: (levels.append(len(searches)), narrow(keys, searches))[1])
    df = _frame(spark, 400, tied_share=0.5).cache()
    order = {"o": [("freq", True), ("key", True)]}
    expect = sorted((r.freq, r.key) for r in df.collect())
    positions = [0, 1, 57, 199, 200, 398, 399]
    got = keys_at(df, order, {"o": positions}, 400, rows_in_task=3, sample_rows=40)["o"]
    assert got == [expect[p] for p in positions]
    assert len(levels) >= 3
    df.unpersist()


def test_scoring_plan_has_no_window_and_few_literals(spark):
    df = _frame(spark, 500)
    out = global_ntiles(df, {"a": [("money", True), ("key", True)], "b": [("freq", False), ("key", True)]}, 4, rows_in_task=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert plan.count(">=") <= 6


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 1003])
@pytest.mark.parametrize("k", [2, 4, 7])
def test_bucket_starts_are_those_of_ntile(n, k):
    base, rem = divmod(n, k)
    sizes = [base + (j < rem) for j in range(k)]
    assert bucket_starts(n, k) == [p for p in (sum(sizes[:j]) for j in range(1, k)) if p < n]


@pytest.mark.parametrize("q", [0.5, 0.99, 0.55, 0.01])
def test_exact_quantile_matches_sorted_position(spark, q):
    rnd = random.Random(7)
    vals = [rnd.randint(0, 300) for _ in range(1002)]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    expect = sorted(vals)[math.ceil(q * len(vals)) - 1]
    assert exact_quantile(df, "x", q, rows_in_task=50, sample_rows=60) == expect


def test_exact_quantile_with_a_dominant_value(spark):
    vals = [7] * 400 + list(range(800))
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    for q in (0.3, 0.5, 0.9):
        assert exact_quantile(df, "x", q, rows_in_task=60, sample_rows=60) == sorted(vals)[math.ceil(q * len(vals)) - 1]


def test_exact_quantile_empty(spark):
    assert exact_quantile(spark.createDataFrame([], "x long"), "x", 0.5) is None


def test_exact_quantile_decimal_and_nulls(spark):
    from decimal import Decimal
    vals = [Decimal(i) / 100 for i in range(1, 501)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,2)")
    clean = sorted(v for v in vals if v is not None)
    for q in (0.5, 0.99):
        assert exact_quantile(df, "x", q, rows_in_task=20, sample_rows=60) == clean[math.ceil(q * len(clean)) - 1]


def test_approx_quantile_within_rank_bound(spark):
    rnd = random.Random(3)
    vals = sorted(rnd.random() for _ in range(5000))
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    err = 0.01
    approx = df.approxQuantile("x", [0.5], err)[0]
    exact = exact_quantile(df, "x", 0.5, rows_in_task=300, sample_rows=60)
    pos = lambda v: vals.index(v)
    assert abs(pos(approx) - pos(exact)) <= err * len(vals) + 1


def test_global_ntiles_equal_separate_ntiles(spark):
    df = _frame(spark, 1003)
    orders = {"a": [("freq", True), ("key", True)], "b": [("money", False), ("key", True)]}
    got = {r.key: (r.a, r.b) for r in global_ntiles(df, orders, 4, rows_in_task=41, sample_rows=60).collect()}
    wa = Window.orderBy(F.col("freq").asc(), F.col("key").asc())
    wb = Window.orderBy(F.col("money").desc(), F.col("key").asc())
    ref = {r.key: (r.a, r.b) for r in df.withColumn("a", F.ntile(4).over(wa)).withColumn("b", F.ntile(4).over(wb)).collect()}
    assert got == ref


@pytest.mark.parametrize("rows_in_task", [5, 100_000])
def test_quantiles_of_several_columns_share_one_search(spark, rows_in_task):
    from emporia.operators.ranking import exact_quantiles

    rng = random.Random(4)
    data = [(rng.choice([None, 1.5, rng.random()]), rng.randrange(50), f"k{rng.randrange(300):03}", None) for _ in range(400)]
    df = spark.createDataFrame(data, "a double, b int, `c d` string, e double").repartition(3)
    want = {}
    for i, name in enumerate(df.columns):
        values = sorted(r[i] for r in data if r[i] is not None)
        want[name] = values[max(1, math.ceil(0.9 * len(values))) - 1] if values else None
    assert exact_quantiles(df, df.columns, 0.9, rows_in_task, sample_rows=20) == want
