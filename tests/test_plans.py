"""Physical-plan checks: no cross products, no Python in the hot path, and no
single-partition exchange for the row-level tables and rankings."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

ROW_LEVEL = ["clean_orders", "clean_customers", "dedup_items", "payments_agg", "items_agg", "latest_review",
             "products_translated", "clean_sellers", "master_featured", "retail_clean", "retail_featured",
             "rfm_orders_best_high", "rfm_orders_as_coded", "rfm_retail", "rfm_capped_exact",
             "clean_payments", "clean_reviews", "rfm_retail_ml", "ml_frame_lr", "ml_frame_dt", "ml_frame_gbt"]


def _plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


# Rows-only queries that need no model fit: the same plan rules apply.
NO_SQL_CHECKED = ["summary_orders", "summary_rfm_retail", "rfm_capped_approx", "gbt_sample_balance"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()) + NO_SQL_CHECKED)
def test_no_cross_product_or_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_level_tables_stay_partitioned(spark, name):
    assert "SinglePartition" not in _plan(spark, name)


def test_order_lines_are_shuffled_once(spark):
    """Both the de-duplication by order line and the totals by order use one exchange by order; none once the lines are saved."""
    from emporia.operators.clean import clean_order_items
    from emporia.operators.enrich import items_per_order
    from emporia.plans.tables import from_testdata

    both = items_per_order(clean_order_items(from_testdata(spark, SF_SMALL).raw["order_items"]))
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert "Exchange" not in _plan(spark, "items_agg")


def test_retail_input_is_planned_once(spark):
    assert _plan(spark, "retail_clean").count("Scan parquet") <= 5


def test_reports_read_pruned_columns_with_pushed_filters(spark):
    plan = E.queries()["q02_monthly_revenue"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in plan
    assert "PartitionFilters: [isnotnull(order_year" in plan or "PartitionFilters: [order_year" in plan
    assert "ReadSchema: struct<order_id:string,order_status:string,total_order_value" in plan
