"""Counts taken by the cleaning pass equal those of separate aggregations."""

import pytest
from pyspark.sql import functions as F

from emporia.operators import clean as C
from emporia.operators import profile as P
from emporia.operators.counted import PassCounts
from emporia.plans import registry
from emporia.plans.tables import CLEAN, CommerceTables, from_testdata
from emporia.sources import testdata
from tests.conftest import SF_SMALL, rows


@pytest.mark.parametrize("name", list(C.RULES))
def test_counts_of_the_pass(spark, name):
    t = from_testdata(spark, SF_SMALL)
    counts = t.counts(name)
    assert {(r.rule, r.rejected) for r in C.rejected(t.raw[name], C.RULES[name], name).collect()} == {
        (rule, n) for _, rule, n in C.rejected_counts(C.RULES[name], counts, name)}
    raw = P.null_counts(t.raw[name]).first().asDict()
    assert raw.pop("_rows") == counts["raw_rows"] and raw == {c: counts["raw_nulls", c] for c in t.raw[name].columns}
    clean = getattr(t, CLEAN[name])
    found = P.null_counts(clean).first().asDict()
    assert found.pop("_rows") == counts["clean_rows"] and found == {c: counts["nulls", c] for c in clean.columns}


def test_reports_equal_those_by_aggregation(spark):
    t = from_testdata(spark, SF_SMALL)
    assert rows(registry._row_counts(t)) == rows(P.row_counts({n: t.raw[n] for n in registry.PROFILED}))
    reports = [P.clean_report(t.raw[n], t.reviews_latest if n == "reviews" else getattr(t, CLEAN[n]), n) for n in registry.PROFILED]
    assert rows(registry._clean_report(t)) == rows(registry._union(reports))
    nulls = [P.null_profile(t.raw[n], n) for n in registry.PROFILED]
    assert rows(registry._null_profile(t)) == rows(registry._union(nulls))


def test_tables_that_are_not_saved_count_on_demand(spark):
    saved = from_testdata(spark, SF_SMALL)
    lazy = CommerceTables(spark, testdata.raw_tables(spark, SF_SMALL), materialize=False)
    assert lazy.counts("payments") == saved.counts("payments")


def test_raw_table_is_read_once(spark):
    """A clean table's counts come from the job that writes it: one scan of the raw rows."""
    seen = spark.sparkContext.accumulator(0)
    raw = spark.createDataFrame([("c1", "u1", "1", "x", "SP"), ("c1", "u1", "1", "x", "SP"), ("c2", None, "2", "y", "RJ")],
                                "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                                "customer_city string, customer_state string")

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    t = CommerceTables(spark, {"customers": raw.mapInArrow(passed, raw.schema)})
    assert t.counts("customers")["raw_rows"] == 3 and t.counts("customers")["clean_rows"] == 1
    assert registry._union([spark.createDataFrame(C.rejected_counts(C.RULES["customers"], t.counts("customers"), "c"))]).count() == 4
    assert seen.value == 3


def test_empty_table(spark):
    raw = {"sellers": spark.createDataFrame([], "seller_id string, seller_zip_code_prefix string, seller_city string, "
                                                "seller_state string")}
    counts = CommerceTables(spark, raw).counts("sellers")
    assert counts["raw_rows"] == counts["clean_rows"] == 0


def test_counts_that_do_not_hold_are_taken_again(spark):
    df = spark.range(10)
    counts = PassCounts()
    counts.watch(df, {"n": F.count(F.lit(1)), ("odd", "id"): F.count_if(F.col("id") % 2 == 1)}).collect()
    asked = []
    assert counts.read(lambda c: asked.append(c) or False) == {"n": 10, ("odd", "id"): 5}
    assert asked == [{"n": 10, ("odd", "id"): 5}]
