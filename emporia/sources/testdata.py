"""Adapter from the driver's TPC-H-like test tables to the commerce tables.

The test tables have no commerce columns, so they are derived here by fixed,
deterministic rules over whole tables (no row is sampled away). The rules are
synthetic and chosen so every cleaning branch meets a real case: statuses
outside the allowed list, missing approval and review dates, non-numeric and
out-of-range review scores, products without category, categories without a
translation, duplicated order lines, zero installments, null freight,
cancelled invoices, unknown retail customers and fully repeated retail lines.
Money is derived as exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.joins import broadcast_if_small

# The test tables the adapter reads (the others in the folder serve other workloads).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# TPC-H-like status code -> order status; return flag -> payment type.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_BY_FLAG = {"A": "credit_card", "N": "boleto", "R": "voucher"}
# Category that has no translation (becomes 'other').
UNTRANSLATED_CATEGORY = "LARGE"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus(unit: str, amount, ts) -> F.Column:
    return F.timestamp_add(unit, amount, ts)


def _dec2(c) -> F.Column:
    return F.col(c).cast("decimal(12,2)")


def _mapped(col: F.Column, mapping: dict, default=None) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default) if default is not None else expr


TS_TEXT = "yyyy-MM-dd HH:mm:ss"
BAD_DATE = "31/02/20xx"


def _text(ts, bad=None) -> F.Column:
    """A timestamp as raw text; where ``bad`` holds, text that is no date."""
    text = F.date_format(ts, TS_TEXT)
    return text if bad is None else F.when(bad, BAD_DATE).otherwise(text)


def _repeated(df: DataFrame, where: F.Column, changes: dict) -> DataFrame:
    """Every row once, and rows where the condition holds a second time with changed columns, in one pass."""
    copies = F.explode(F.when(where, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    twice = df.withColumn("_copy", copies)
    changed = {c: F.when(F.col("_copy") == 1, x).otherwise(F.col(f"`{c}`")) for c, x in changes.items()}
    return (twice.withColumns(changed) if changed else twice).drop("_copy")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 97 == 0, "lost").otherwise(_mapped(F.col("o_orderstatus"), STATUS_BY_CODE))
    purchase = _plus("HOUR", k % 24, F.col("o_orderdate"))
    rows = read(spark, sf_dir, "orders").select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        _text(purchase, k % 211 == 0).alias("order_purchase_timestamp"),
        F.when(k % 11 != 0, _text(_plus("DAY", k % 4, purchase), k % 83 == 0)).alias("order_approved_at"),
        F.when(status.isin("delivered", "shipped"), _text(_plus("DAY", k % 5, purchase))).alias("order_delivered_carrier_date"),
        F.when(status == "delivered", _text(_plus("DAY", k % 40, purchase))).alias("order_delivered_customer_date"),
        _text(_plus("DAY", F.lit(20), purchase)).alias("order_estimated_delivery_date"),
        k.alias("_k"), _text(_plus("DAY", F.lit(1), purchase)).alias("_later"),
    )
    later = {"order_purchase_timestamp": F.col("_later"), "order_status": F.lit("created")}
    return _repeated(rows, F.col("_k") % 71 == 0, later).drop("_k", "_later")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = broadcast_if_small(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    k = F.col("c_custkey")
    state = (F.when(k % 101 == 0, F.lit(None).cast("string"))
             .when(k % 3 == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
             .otherwise(F.col("n_name")))
    city = F.when(k % 2 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(F.lower("c_mktsegment"))
    rows = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        k.cast("string").alias("customer_id"),
        F.when(k % 10 == 9, k - 1).otherwise(k).cast("string").alias("customer_unique_id"),
        city.alias("customer_city"),
        state.alias("customer_state"), k.alias("_k"),
    )
    return _repeated(rows, F.col("_k") % 61 == 0, {"customer_city": F.lit("~moved")}).drop("_k")


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    freight = (_dec2("l_extendedprice") * _dec2("l_tax")).cast("decimal(18,4)")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _text(F.col("l_shipdate"), (F.col("l_orderkey") + F.col("l_linenumber")) % 89 == 0).alias("shipping_limit_date"),
        _dec2("l_extendedprice").cast("decimal(18,4)").alias("price"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 53 != 0, freight).alias("freight_value"),
    )


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    value = _dec2("l_extendedprice") * (F.lit(1) - _dec2("l_discount")) * (F.lit(1) + _dec2("l_tax"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _mapped(F.col("l_returnflag"), PAYMENT_BY_FLAG).alias("payment_type"),
        (F.col("l_linenumber") % 7).alias("payment_installments"),
        F.round(value, 4).cast("decimal(18,4)").alias("payment_value"),
    )


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.col("event_id")
    score = (F.when(k % 29 == 0, F.lit("n/a"))
             .when(k % 31 == 0, F.lit("6"))
             .otherwise((F.floor("value") % 5 + 1).cast("string")))
    rows = e.select(
        k.cast("string").alias("review_id"),
        F.expr("event_id div 2").cast("string").alias("order_id"),
        score.alias("review_score"),
        F.when(k % 37 != 0, _text(F.col("ts"), k % 41 == 0)).alias("review_creation_date"),
        _text(_plus("HOUR", k % 72, F.col("ts"))).alias("review_answer_timestamp"), k.alias("_k"),
    )
    return _repeated(rows, F.col("_k") % 67 == 0, {"review_score": F.lit("1"), "order_id": F.lit("~")}).drop("_k")


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size")
    rows = read(spark, sf_dir, "part").select(
        k.cast("string").alias("product_id"),
        F.when(k % 19 != 0, F.col("p_type")).alias("product_category_name"),
        F.when(k % 13 != 0, size * 100.0).alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 10 + 1).cast("double").alias("product_height_cm"),
        (size % 7 + 1).cast("double").alias("product_width_cm"), k.alias("_k"),
    )
    return _repeated(rows, F.col("_k") % 47 == 0, {"product_category_name": F.lit("~other")}).drop("_k")


def category_translation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    names = (p.filter(F.col("p_type") != UNTRANSLATED_CATEGORY)
             .groupBy(F.col("p_type").alias("product_category_name"))
             .agg(F.lower(F.first("p_type")).alias("product_category_name_english")))
    return _repeated(names, F.lit(True), {"product_category_name_english": F.concat(F.lit("~"), "product_category_name_english")})


def sellers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    n = broadcast_if_small(read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    r = broadcast_if_small(read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    rows = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    F.col("r_name").alias("seller_city"),
                    F.col("n_name").alias("seller_state"), F.col("s_suppkey").alias("_k")))
    return _repeated(rows, F.col("_k") % 3 == 0, {"seller_state": F.lit("~elsewhere")}).drop("_k")


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = broadcast_if_small(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    # The customers are joined to the narrow orders, so the lines are shuffled by order and by part only.
    buyers = (o.join(c, F.col("o_custkey") == c.c_custkey, "left")
              .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    j = (li.join(buyers, li.l_orderkey == F.col("o_orderkey"), "inner")
         .join(p, F.col("l_partkey") == p.p_partkey, "left"))
    qty = F.col("l_quantity").cast("bigint")
    # Unit price in whole cents, rounded half up with integer arithmetic.
    unit_cents = F.expr(
        "(2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))"
        " div (2 * CAST(l_quantity AS BIGINT))")
    cancelled = F.col("l_returnflag") == "R"
    rows = j.select(
        F.concat(F.when(cancelled, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("l_partkey") % 23 != 0, F.col("p_name")).alias("Description"),
        F.when(cancelled, -qty).otherwise(qty).cast("int").alias("Quantity"),
        _text(_plus("HOUR", F.col("l_linenumber") * 3, F.col("o_orderdate")),
              (F.col("l_orderkey") + F.col("l_linenumber")) % 97 == 0).alias("InvoiceDate"),
        (unit_cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").alias("Price"),
        F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey")).alias("Customer ID"),
        F.concat(F.lit(" "), F.col("n_name")).alias("Country"),
        F.col("l_orderkey").alias("_k"),
    )
    return _repeated(rows, F.col("_k") % 50 == 0, {}).drop("_k")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw commerce tables derived from the test tables under ``sf_dir``."""
    return {
        "orders": orders_raw(spark, sf_dir),
        "customers": customers_raw(spark, sf_dir),
        "order_items": order_items_raw(spark, sf_dir),
        "payments": payments_raw(spark, sf_dir),
        "reviews": reviews_raw(spark, sf_dir),
        "products": products_raw(spark, sf_dir),
        "category_translation": category_translation_raw(spark, sf_dir),
        "sellers": sellers_raw(spark, sf_dir),
        "retail": retail_raw(spark, sf_dir),
    }
