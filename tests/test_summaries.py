"""The four summaries from one pass, the refresh of single years, and the exact ROC area."""

import random

import pytest
from pyspark.ml.linalg import Vectors

from emporia.models import evaluate as MV
from emporia.operators import reports as Q
from emporia.plans import batch_job
from emporia.plans.tables import from_testdata, materialized
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def t(spark):
    return from_testdata(spark, SF_SMALL)


@pytest.mark.parametrize("alone,of_cells", [(Q.r1_monthly, Q.r1_of_cells), (Q.r2_category, Q.r2_of_cells), (Q.r3_state, Q.r3_of_cells),
                                            (Q.r4_payments, Q.r4_of_cells)])
def test_summaries_equal_their_own_queries(t, alone, of_cells):
    one, other = of_cells(Q.summary_cells(t.master_featured)), alone(t.master_featured)
    assert one.columns == other.columns and rows(one) == rows(other)


def test_summaries_scan_the_orders_once(t):
    plan = Q.summary_cells(t.master_featured)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_refresh_of_saved_years(spark, t, tmp_path):
    out = str(tmp_path)
    batch_job.save_table(t.master_featured.filter("order_year <> 1996"), "m", f"{out}/tables/master_featured", partition_by=["order_year"])
    files = lambda: {f.relative_to(tmp_path): f.stat().st_mtime_ns for f in tmp_path.rglob("part-*")}
    before = files()
    got = batch_job.refresh(t, out, [1996, 1997])
    assert rows(got) == rows(batch_job.orders_by_year(t.master_featured))
    kept = {f for f in before if "order_year=1997" not in str(f)}
    assert {f: before[f] for f in kept} == {f: files()[f] for f in kept} and kept
    saved = spark.read.parquet(f"{out}/tables/master_featured").select(*t.master_featured.columns)
    assert rows(saved.filter("order_year = 1997")) == rows(t.master_featured.filter("order_year = 1997"))


def _scored(spark, pairs):
    data = [(y, Vectors.dense([1 - p, p])) for p, y in pairs]
    schema = spark.createDataFrame([(1, Vectors.dense([0.0, 1.0]))], ["y", "probability"]).schema
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.mark.parametrize("seed,digits", [(1, 1), (2, 6)])
def test_exact_area_equals_all_pairs(spark, seed, digits):
    rng = random.Random(seed)
    pairs = [(round(rng.random(), digits), int(rng.random() < 0.4)) for _ in range(300)]
    ranked = MV.ranked_scores(_scored(spark, pairs), "y", materialized)
    r = MV.exact_area(ranked, "m").first()
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    assert (r.positives, r.negatives) == (len(pos), len(neg)) and r.auc == pytest.approx(won / len(pos) / len(neg), abs=1e-12)
    above = {x.score: (x.pos_above, x.neg_above) for x in ranked.collect()}
    assert above == {s: (sum(p > s for p in pos), sum(p > s for p in neg)) for s, _ in pairs}


def test_area_without_a_class(spark):
    assert MV.exact_area(MV.ranked_scores(_scored(spark, [(0.5, 1)]), "y", materialized), "m").first().auc is None
