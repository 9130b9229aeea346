from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small, hot_keys, left_lookup, left_lookup_split
from emporia.operators.enrich import build_master
from emporia.plans.tables import from_testdata
from tests.conftest import SF_SMALL, rows


def _fact(spark):
    # One key ("p0") holds a third of the rows; some keys have no dimension row; some are null.
    return spark.range(3000).select(
        F.col("id").alias("line"),
        F.when(F.col("id") % 3 == 0, F.lit("p0"))
         .when(F.col("id") % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("product"))


def _dim(spark):
    return spark.createDataFrame([(f"p{i}", f"cat{i % 4}") for i in range(0, 45)], "pid string, cat string")


def test_hot_keys_bounded(spark):
    assert hot_keys(_fact(spark), "product", max_hot=10, min_rows=10) == ["p0"]


def test_split_lookup_equals_plain_lookup(spark):
    fact, dim = _fact(spark), _dim(spark)
    plain = left_lookup(fact, dim, "product", "pid")
    split = left_lookup_split(fact, dim, "product", "pid", max_hot=10, min_rows=10)
    assert split.count() == fact.count()
    assert rows(split) == rows(plain)
    assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_split_lookup_with_null_heavy_key(spark):
    # A third of the keys are null: null must not become a "hot key" and drop cold rows.
    fact = spark.range(900).select(F.col("id").alias("line"),
                                   F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
                                    .otherwise(F.concat(F.lit("p"), (F.col("id") % 7).cast("string"))).alias("product"))
    dim = _dim(spark)
    split = left_lookup_split(fact, dim, "product", "pid", max_hot=4, min_rows=10)
    assert split.count() == 900
    assert rows(split) == rows(left_lookup(fact, dim, "product", "pid"))
    # nulls plus a genuinely hot key
    fact2 = fact.withColumn("product", F.when(F.col("line") % 3 == 1, F.lit("p0")).otherwise(F.col("product")))
    assert hot_keys(fact2, "product", max_hot=10, min_rows=10) == ["p0"]
    split2 = left_lookup_split(fact2, dim, "product", "pid", max_hot=10, min_rows=10)
    assert split2.count() == 900
    assert rows(split2) == rows(left_lookup(fact2, dim, "product", "pid"))


def test_broadcast_if_small_checks_size(spark):
    small = spark.range(10)
    assert "broadcast" in str(broadcast_if_small(small, 100)._jdf.queryExecution().logical()).lower()
    big = spark.range(1000)
    assert broadcast_if_small(big, 100) is big


def test_master_with_hot_key_split_is_the_same(spark):
    t = from_testdata(spark, SF_SMALL)
    args = (t.orders_clean, t.customers_clean, t.items_agg, t.payments_agg, t.reviews_latest,
            t.products_clean, t.sellers_clean)
    a = build_master(*args)
    b = build_master(*args, split_hot_keys=True)
    assert a.columns == b.columns
    assert rows(a.select("order_id", "customer_state", "main_product_id", "seller_state")) == \
        rows(b.select("order_id", "customer_state", "main_product_id", "seller_state"))
