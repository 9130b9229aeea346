from datetime import datetime

from pyspark.sql import functions as F

from emporia.operators.dedup import dedup_by_key, distinct_rows, latest_per_key
from tests.conftest import rows


def test_dedup_by_key_keeps_smallest_by_order(spark):
    df = spark.createDataFrame(
        [("o1", 1, 9.0, "p2"), ("o1", 1, 5.0, "p9"), ("o1", 1, 5.0, "p1"), ("o2", 1, None, "p3"), ("o2", 1, 1.0, "p4")],
        "order_id string, item int, price double, product string")
    out = {(r.order_id, r.item): (r.price, r.product) for r in dedup_by_key(df, ["order_id", "item"], ["price"]).collect()}
    assert out == {("o1", 1): (5.0, "p1"), ("o2", 1): (None, "p3")}
    assert dedup_by_key(df, ["order_id", "item"], ["price"]).columns == df.columns


def test_dedup_is_partition_invariant(spark):
    data = [(f"k{i % 17}", i % 5, f"v{(i * 7) % 11}") for i in range(500)]
    df = spark.createDataFrame(data, "k string, a int, b string")
    expect = rows(dedup_by_key(df, ["k"], ["a"]))
    for n in (1, 4, 13):
        assert rows(dedup_by_key(df.repartition(n), ["k"], ["a"])) == expect


def test_latest_per_key_null_dates_lose_and_ties_go_to_greatest_id(spark):
    t1, t2 = datetime(2020, 1, 1), datetime(2020, 1, 2)
    df = spark.createDataFrame(
        [("r1", "o1", 5, t1), ("r2", "o1", 3, t2), ("r3", "o2", 4, None), ("r4", "o2", 2, t1),
         ("r5", "o3", 1, t2), ("r6", "o3", 2, t2), ("r7", "o4", 1, None)],
        "review_id string, order_id string, score int, created timestamp")
    out = {r.order_id: r.review_id for r in latest_per_key(df, "order_id", "created", "review_id").collect()}
    assert out == {"o1": "r2", "o2": "r4", "o3": "r6", "o4": "r7"}


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert distinct_rows(df).count() == 2


def test_hot_key_dedup_is_combined_before_shuffle(spark):
    # A key holding a third of all rows: the plan aggregates partially before the exchange.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("v"))
    plan = dedup_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert dedup_by_key(df, ["k"], ["v"]).filter(F.col("k") == "hot").first().v == 0
