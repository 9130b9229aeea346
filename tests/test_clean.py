from datetime import datetime

from emporia.operators import clean as C
from emporia.sources import schemas
from emporia.sources.files import load_csv


def test_clean_orders_rules(spark):
    raw = spark.createDataFrame([
        ("o1", "c1", "delivered", "2018-01-01 10:00:00", None, None, "2018-01-05 10:00:00", "2018-01-06 00:00:00"),
        ("o1", "c1", "delivered", "2018-01-02 10:00:00", None, None, None, None),   # duplicate id, later
        ("o2", "c2", "lost", "2018-01-01 10:00:00", None, None, None, None),        # status not allowed
        ("o3", None, "shipped", "2018-01-01 10:00:00", None, None, None, None),     # missing customer
        ("o4", "c4", "shipped", "not a date", None, None, None, None),              # bad purchase time
        ("o5", "c5", "canceled", "2018-03-01 08:30:00", "bad", None, None, None),
    ], schemas.ORDERS)
    out = {r.order_id: r for r in C.clean_orders(raw).collect()}
    assert set(out) == {"o1", "o5"}
    assert out["o1"].order_purchase_timestamp == datetime(2018, 1, 1, 10, 0)
    assert out["o5"].order_approved_at is None


def test_clean_customers_and_sellers_normalise_text(spark):
    raw = spark.createDataFrame([("c1", "u1", "1", "  Sao Paulo ", " sp "), ("c1", "u1", "1", "x", "SP"),
                                 ("c2", "u2", "2", "rio", None)], schemas.CUSTOMERS)
    out = C.clean_customers(raw).collect()
    assert len(out) == 1 and out[0].customer_state == "SP"
    s = spark.createDataFrame([("s1", "1", " Curitiba", "pr ")], schemas.SELLERS)
    r = C.clean_sellers(s).first()
    assert (r.seller_city, r.seller_state) == ("curitiba", "PR")


def test_clean_items_filters_and_dedups(spark):
    raw = spark.createDataFrame([
        ("o1", 1, "p1", "s1", "2018-01-01 00:00:00", 10.0, 1.0),
        ("o1", 1, "p2", "s1", "2018-01-01 00:00:00", 12.0, 1.0),   # duplicate line, larger price
        ("o1", 2, "p1", "s1", "2018-01-01 00:00:00", 0.0, 1.0),    # price 0
        ("o1", 3, "p1", "s1", "2018-01-01 00:00:00", 5.0, -1.0),   # negative freight
        ("o1", 4, "p1", "s1", "2018-01-01 00:00:00", 5.0, None),   # null freight
        ("o2", 1, None, "s1", "2018-01-01 00:00:00", 5.0, 0.0),    # no product
    ], schemas.ORDER_ITEMS)
    out = C.clean_order_items(raw).collect()
    assert [(r.order_id, r.order_item_id, r.product_id) for r in out] == [("o1", 1, "p1")]
    assert str(out[0].price) == "10.0000"


def test_clean_payments_and_reviews(spark):
    p = spark.createDataFrame([("o1", 1, "boleto", 1, 10.0), ("o1", 2, "voucher", 0, 5.0),
                               ("o2", 1, "credit_card", 2, -1.0)], schemas.PAYMENTS)
    assert [r.payment_type for r in C.clean_payments(p).collect()] == ["boleto"]
    r = spark.createDataFrame([
        ("r1", "o1", "5", None, None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
        ("r2", "o1", "x", None, None, "2018-01-03 00:00:00", None),
        ("r3", "o1", "0", None, None, "2018-01-03 00:00:00", None),
        ("r4", "o1", "6", None, None, "2018-01-03 00:00:00", None),
        ("r5", "o2", "3", None, None, "garbage", None),
        ("r5", "o2", "3", None, None, "garbage", None),
    ], schemas.REVIEWS)
    clean = C.clean_reviews(r)
    assert sorted(x.review_id for x in clean.collect()) == ["r1", "r5"]
    latest = {x.order_id: x.review_id for x in C.latest_reviews(clean).collect()}
    assert latest == {"o1": "r1", "o2": "r5"}


def test_products_category_fill_and_translation(spark):
    p = spark.createDataFrame([("p1", "beleza", None, None, None, 1.0, 1.0, 1.0, 1.0),
                               ("p2", None, None, None, None, None, None, None, None),
                               ("p3", "novidade", None, None, None, None, 2.0, 2.0, 2.0)], schemas.PRODUCTS)
    t = spark.createDataFrame([("beleza", "beauty"), ("beleza", "beauty"), ("x", None)], schemas.CATEGORY_TRANSLATION)
    out = {r.product_id: (r.product_category_name, r.product_category_name_english, r.product_weight_g)
           for r in C.clean_products(p, t).collect()}
    assert out == {"p1": ("beleza", "beauty", 1.0), "p2": ("unknown", "other", 0.0), "p3": ("novidade", "other", 0.0)}


def test_clean_retail_rules_and_idempotence(spark):
    raw = spark.createDataFrame([
        ("1001", "A", "Mug", 2, "2010-12-01 08:26:00", 2.55, 17850.0, " United Kingdom"),
        ("1001", "A", "Mug", 2, "2010-12-01 08:26:00", 2.55, 17850.0, " United Kingdom"),  # repeated line
        ("C1002", "B", "Box", 1, "2010-12-01 09:00:00", 1.0, 1.0, "France"),               # cancelled
        ("1003", "C", None, -3, "2010-12-01 09:00:00", 1.0, 1.0, "France"),                # negative quantity
        ("1004", "D", None, 3, "2010-12-02 10:00:00", 1.005, None, "France"),
    ], schemas.RETAIL)
    out = C.clean_retail(raw)
    got = {r.Invoice: (r.Description, r["Customer ID"], r.Country, str(r.TotalLineValue)) for r in out.collect()}
    assert got == {"1001": ("Mug", 17850.0, "United Kingdom", "5.10"), "1004": ("UNKNOWN", -1.0, "France", "3.02")}
    assert C.clean_retail(out).count() == out.count()


def test_csv_reader_multiline_and_escaped_quotes(spark, tmp_path):
    f = tmp_path / "reviews.csv"
    f.write_text('review_id,order_id,review_score,review_comment_title,review_comment_message,'
                 'review_creation_date,review_answer_timestamp\n'
                 'r1,o1,5,"Good","line one\nline ""two""",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
                 'r2,o2,4,,,2018-01-01 00:00:00,2018-01-02 00:00:00\n')
    df = load_csv(spark, str(f), schemas.REVIEWS)
    rows = {r.review_id: r for r in df.collect()}
    assert len(rows) == 2
    assert rows["r1"].review_comment_message == 'line one\nline "two"'


def test_text_timestamps_keep_wall_clock_in_any_zone(spark):
    from emporia.functions.columns import as_timestamp
    from pyspark.sql.types import StringType
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2018-03-11 02:30:00",), ("garbage",), ("2018-01-01",)], "s string")
        got = [r.t for r in df.select(as_timestamp("s", StringType()).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [datetime(2018, 3, 11, 2, 30), None, None]
