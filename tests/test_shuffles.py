"""What the large joins and the saved tables shuffle: keys and narrow rows, and no row twice by the same key."""

import re

import pytest

from emporia.operators import clean as C
from emporia.operators import enrich as E
from emporia.operators.counted import PassCounts
from emporia.plans.tables import CommerceTables, from_testdata
from emporia.sources import testdata
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def t(spark):
    return from_testdata(spark, SF_SMALL)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _exchanged(df, key):
    """The column lists of the exchanges by ``key``."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\) Exchange\s+Input \[\d+\]: \[([^\]]*)\]\s+Arguments: hashpartitioning\((\w+)#", plan)
    return [set(re.sub(r"#\d+L?", "", columns).split(", ")) for columns, k in found if k == key]


def test_customers_are_looked_up_by_the_orders_keys(spark, t, no_broadcast):
    master = E.master_by_keys(t.orders_clean, t.customers_clean, t.items_side, t.payments_agg, t.reviews_latest)
    assert _exchanged(master, "customer_id") == [{"order_id", "customer_id"}]
    whole = E.master_by_order(t.orders_clean, t.customers_clean, t.items_side, t.payments_agg, t.reviews_latest)
    assert master.columns == whole.columns and rows(master) == rows(whole)
    assert _exchanged(t.master.select("*"), "customer_id") == [{"order_id", "customer_id"}]


def test_order_lines_go_into_their_buckets_in_one_exchange(spark, t):
    lines = C.clean_counted(t.raw["order_items"], C.RULES["order_items"], PassCounts(), parts=5)
    assert len(_exchanged(lines.repartition(5, "order_id"), "order_id")) == 1


def test_featured_orders_dealt_before_the_features_are_the_same_rows(spark, t):
    lazy = CommerceTables(spark, testdata.raw_tables(spark, SF_SMALL), materialize=False).master_featured
    assert sorted(lazy.columns) == sorted(t.master_featured.columns)
    assert rows(lazy.select(t.master_featured.columns)) == rows(t.master_featured)


def test_retail_lines_are_not_shuffled_by_customer(spark, no_broadcast):
    by_customer = _exchanged(testdata.retail_raw(spark, SF_SMALL), "o_custkey")
    assert by_customer and not any(c.startswith("l_") for columns in by_customer for c in columns)
