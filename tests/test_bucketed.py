"""Tables saved in buckets by order: joins and totals by order without an exchange."""

import pytest

from emporia.operators import enrich as E
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


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_master_and_totals_have_no_exchange_by_order(spark, t, no_broadcast):
    master = E.master_by_order(t.orders_clean, t.customers_clean, t.items_side, t.payments_agg, t.reviews_latest)
    for df in (master, t.items_agg, t.payments_agg, t.reviews_latest):
        plan = _plan(df)
        assert "hashpartitioning(order_id" not in plan
    assert _plan(master).count("SortMergeJoin") == 4
    assert _plan(master).count("Exchange hashpartitioning(customer_id") == 1
    assert "Exchange" not in _plan(t.items_agg)


def test_rows_equal_the_unsaved_build(spark, t):
    lazy = CommerceTables(spark, testdata.raw_tables(spark, SF_SMALL), materialize=False)
    assert lazy.master.columns == t.master.columns
    assert rows(t.master) == rows(lazy.master)


def test_number_of_buckets_and_dropping_the_tables(spark):
    tables = CommerceTables(spark, testdata.raw_tables(spark, SF_SMALL), buckets=3)
    n = tables.payments_clean.count()
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {tables.bucketed[0]}").collect()}
    assert detail["Num Buckets"] == "3" and detail["Bucket Columns"] == "[`order_id`]" and detail["Sort Columns"] == "[`order_id`]"
    path = detail["Location"]
    tables.drop_bucketed()
    assert not tables.bucketed and spark.read.parquet(path).count() == n
