"""The derived test tables really contain the dirty cases the cleaners handle."""

import pytest
from pyspark.sql import functions as F

from emporia.sources import testdata
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return testdata.raw_tables(spark, SF_SMALL)


def test_orders_have_unknown_status_and_missing_dates(raw):
    o = raw["orders"]
    assert o.filter(F.col("order_status") == "lost").count() > 0
    assert o.filter(F.col("order_approved_at").isNull()).count() > 0
    assert o.filter(~F.col("order_status").isin("delivered", "created") & F.col("order_delivered_customer_date").isNotNull()).count() == 0


def test_items_have_duplicate_lines_and_null_freight(raw):
    i = raw["order_items"]
    dup = i.groupBy("order_id", "order_item_id").count().filter(F.col("count") > 1).count()
    assert dup > 0
    assert i.filter(F.col("freight_value").isNull()).count() > 0


def test_reviews_have_bad_scores_and_null_dates(raw):
    r = raw["reviews"]
    assert r.filter(F.col("review_score") == "n/a").count() > 0
    assert r.filter(F.col("review_score") == "6").count() > 0
    assert r.filter(F.col("review_creation_date").isNull()).count() > 0
    assert r.groupBy("order_id").count().filter(F.col("count") > 1).count() > 0


def test_payments_products_customers_retail_cases(raw):
    assert raw["payments"].filter(F.col("payment_installments") == 0).count() > 0
    assert raw["products"].filter(F.col("product_category_name").isNull()).count() > 0
    assert raw["category_translation"].filter(F.col("product_category_name") == "LARGE").count() == 0
    c = raw["customers"]
    assert c.filter(F.col("customer_state").isNull()).count() > 0
    assert c.filter(F.col("customer_state") != F.upper(F.trim("customer_state"))).count() > 0
    assert c.groupBy("customer_unique_id").count().filter(F.col("count") > 1).count() > 0
    rt = raw["retail"]
    assert rt.filter(F.col("Invoice").startswith("C")).count() > 0
    assert rt.filter(F.col("Quantity") < 0).count() > 0
    assert rt.filter(F.col("Customer ID").isNull()).count() > 0
    assert rt.filter(F.col("Description").isNull()).count() > 0
    assert rt.count() > rt.distinct().count()


def test_text_timestamps_and_malformed_dates(raw):
    for table, column in (("orders", "order_purchase_timestamp"), ("orders", "order_approved_at"), ("reviews", "review_creation_date"),
                          ("order_items", "shipping_limit_date"), ("retail", "InvoiceDate")):
        df = raw[table]
        assert dict(df.dtypes)[column] == "string"
        assert df.filter(F.col(column) == testdata.BAD_DATE).count() > 0, (table, column)


@pytest.mark.parametrize("table, key", [("orders", "order_id"), ("customers", "customer_id"), ("reviews", "review_id"),
                                        ("products", "product_id"), ("sellers", "seller_id"),
                                        ("category_translation", "product_category_name")])
def test_keys_are_repeated_with_other_values(raw, table, key):
    df = raw[table].distinct()
    assert df.groupBy(key).count().filter(F.col("count") > 1).count() > 0
