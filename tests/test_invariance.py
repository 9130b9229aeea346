"""Results do not depend on how the inputs are partitioned."""

import pytest

from emporia.operators import reports as Q
from emporia.plans.tables import CommerceTables
from emporia.sources import testdata
from tests.conftest import SF_SMALL, rows


def _tables(spark, n):
    raw = {k: v.repartition(n) for k, v in testdata.raw_tables(spark, SF_SMALL).items()}
    return CommerceTables(spark, raw, rows_in_task=50, materialize=False)


@pytest.fixture(scope="module")
def base(spark):
    return _tables(spark, 1)


@pytest.mark.parametrize("n", [4, 13])
def test_partitioning_invariance(spark, base, n):
    other = _tables(spark, n)
    for name in ("items_clean", "payments_agg", "items_agg", "reviews_latest"):
        assert rows(getattr(other, name)) == rows(getattr(base, name)), name
    assert rows(other.rfm_olist) == rows(base.rfm_olist)
    assert rows(Q.q05_segments(other.rfm_olist)) == rows(Q.q05_segments(base.rfm_olist))
    assert rows(Q.q18_best_sellers(other.retail_featured)) == rows(Q.q18_best_sellers(base.retail_featured))
