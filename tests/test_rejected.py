"""Rejected-row counts add up to what cleaning takes out."""

import pytest

from emporia.operators import clean as C
from emporia.plans.tables import from_testdata
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", list(C.RULES))
def test_rejected_rows_add_up(spark, name):
    raw = from_testdata(spark, SF_SMALL).raw[name]
    counts = {r.rule: r.rejected for r in C.rejected(raw, C.RULES[name], name).collect()}
    assert raw.count() - C.clean(raw, C.RULES[name]).count() == sum(counts.values())
    assert all(v >= 0 for v in counts.values())


def test_a_row_counts_under_the_first_rule_it_fails(spark):
    rows = [("o1", 1, "p", "s", "2017-01-01 00:00:00", 5.0, 1.0), ("o1", 1, "p", "s", "x", 6.0, 1.0),
            ("o2", 1, None, "s", None, -1.0, None), ("o3", 1, "p", "s", None, 0.0, -1.0), ("o4", 1, "p", "s", None, 2.0, None)]
    raw = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string, seller_id string, "
                                      "shipping_limit_date string, price double, freight_value double")
    counts = {r.rule: r.rejected for r in C.rejected(raw, C.RULES["order_items"], "x").collect()}
    assert {k: v for k, v in counts.items() if v} == {
        "product_id present": 1, "price above 0": 1, "freight not below 0": 1, "one row per key": 1}
