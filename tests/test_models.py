"""Model tables: invariants (no SQL form exists for them)."""

import pytest
from pyspark.sql import functions as F

from emporia.models import evaluate as MV
from emporia.models.stages import build_pipeline, feature_names, hash_split
from emporia.plans import registry
from emporia.plans.tables import fitted, from_testdata, ml_source
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return from_testdata(spark, SF_SMALL)


def test_hash_split_is_stable_under_repartition(spark):
    df = spark.range(2000).select((F.col("id") % 97).alias("a"), (F.col("id") * 3).alias("b"))
    tr, te = hash_split(df, "b")
    tr4, _ = hash_split(df.repartition(7), "b")
    assert 0.75 < tr.count() / 2000 < 0.85
    assert tr.count() + te.count() == 2000
    assert sorted(map(tuple, tr.collect())) == sorted(map(tuple, tr4.collect()))


def test_feature_names_cover_vector(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "x double, c string")
    model = build_pipeline(["x"], ["c"]).fit(df)
    out = model.transform(df)
    names = feature_names(out, "features")
    assert names[0] == "x" and len(names) == out.first().features.size


def test_confusion_cells_sum_to_test_rows(t):
    f = fitted(t, "dt")
    cm = MV.confusion_matrix(f.predictions, f.spec.label, f.spec.name)
    assert cm.agg(F.sum("count")).first()[0] == f.test.count()


def test_binned_roc_area_close_to_evaluator(spark, t):
    f = fitted(t, "lr")
    area = MV.roc_area(MV.roc_points(f.predictions, f.spec.label, f.spec.name)).first().auc
    auc = MV.binary_metrics(spark, f.predictions, f.spec.label, f.spec.name).first().auc_roc
    assert abs(area - auc) < 0.02


def test_metrics_rows_and_ranges(spark):
    qs = registry.queries()
    for name in ("lr_metrics", "dt_metrics"):
        row = qs[name](spark, SF_SMALL).first()
        for m in ("accuracy", "precision", "recall", "f1", "auc_roc"):
            assert 0.0 <= row[m] <= 1.0


def test_kmeans_tables(spark):
    qs = registry.queries()
    sweep = qs["kmeans_sweep"](spark, SF_SMALL).collect()
    assert [r.k for r in sorted(sweep, key=lambda r: r.k)] == list(range(2, 9))
    profile = qs["kmeans_profile"](spark, SF_SMALL).collect()
    assigned = qs["kmeans_assignments"](spark, SF_SMALL)
    assert sum(r.customer_count for r in profile) == assigned.count()
    assert assigned.filter(F.col("segment_label").isNull()).count() == 0
    share = qs["kmeans_share"](spark, SF_SMALL).collect()
    assert abs(sum(r.share_pct for r in share) - 100) < 0.5


def test_roc_with_a_single_class_gives_null_rates(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    schema = StructType([StructField("y", IntegerType()), StructField("probability", VectorUDT())])
    df = spark.createDataFrame([(1, Vectors.dense([0.2, 0.8])), (1, Vectors.dense([0.6, 0.4]))], schema)
    pts = MV.roc_points(df, "y", "m", bins=10).collect()
    assert len(pts) == 11 and all(p.fpr is None for p in pts)


@pytest.mark.parametrize("key", ["lr", "dt"])
def test_training_uses_every_model_row(t, key):
    """No cap: train + test together are the whole model frame."""
    from emporia.models.classifiers import SPECS
    from emporia.models.prep import model_frame
    from emporia.plans.tables import ml_source

    assert all(s.train_share == 1 for s in SPECS.values())
    spec = SPECS[key]
    f = fitted(t, key)
    whole = model_frame(ml_source(t, key), spec.numeric, spec.categorical, spec.label).count()
    assert f.train.count() + f.test.count() == whole
    assert f.predictions.count() == f.test.count()


def test_samples_follow_the_key_only(spark):
    from emporia.models.stages import sample_by_key

    df = spark.range(4000).select((F.col("id") % 1000).alias("_key"), F.rand(1).alias("x"))
    some = sample_by_key(df, 0.25)
    keys = {r[0] for r in some.select("_key").distinct().collect()}
    assert 0.2 < len(keys) / 1000 < 0.3
    assert some.count() == 4 * len(keys)
    assert {r[0] for r in sample_by_key(df.repartition(9), 0.25).select("_key").distinct().collect()} == keys


def test_training_on_a_share_of_the_keys(t):
    from dataclasses import replace

    from emporia.models.classifiers import SPECS, train
    from emporia.plans.tables import ml_source

    half = train(replace(SPECS["dt"], train_share=0.5), ml_source(t, "dt"))
    whole = fitted(t, "dt")
    assert half.predictions.count() == whole.predictions.count()          # all test rows are scored
    assert half.train.count() == whole.train.count()


def test_metrics_equal_the_evaluators(spark, t):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    f = fitted(t, "dt")
    row = MV.binary_metrics(spark, f.predictions, f.spec.label, f.spec.name).first()
    m = MulticlassClassificationEvaluator(labelCol=f.spec.label, predictionCol="prediction")
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert abs(row[ours] - m.setMetricName(theirs).evaluate(f.predictions)) < 1e-9


def test_nothing_stays_cached(spark, t):
    fitted(t, "dt")
    registry.queries()["dt_metrics"](spark, SF_SMALL).collect()
    registry.queries()["kmeans_profile"](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_fit_on_a_bounded_number_of_rows(spark):
    from dataclasses import replace

    from emporia.models import classifiers

    t = from_testdata(spark, SF_SMALL)
    spec = replace(classifiers.SPECS["dt"], train_rows=200)
    small = classifiers.train(spec, ml_source(t, "dt"), keep=t._keep)
    full = classifiers.train(classifiers.SPECS["dt"], ml_source(t, "dt"), keep=t._keep)
    assert small.predictions.count() == full.predictions.count() == full.test.count()
    root = lambda f: float(f.estimator._java_obj.rootNode().impurityStats().count())
    assert 100 < root(small) < 300 < root(full) == full.train.count()


def test_frame_of_a_fit_takes_no_memory(spark, t, monkeypatch):
    """Memory is left to the rows that the fit itself keeps: the training frame and its sample wait on disk."""
    from dataclasses import replace

    from emporia.models import classifiers

    build, kept = classifiers.build_pipeline, []

    class Watched:
        def __init__(self, *args):
            self.pipeline = build(*args)

        def fit(self, df):
            df.count()
            kept.extend((r.getStorageLevel().useMemory(), r.getStorageLevel().useDisk())
                        for r in spark.sparkContext._jsc.getPersistentRDDs().values())
            return self.pipeline.fit(df)

    monkeypatch.setattr(classifiers, "build_pipeline", Watched)
    classifiers.train(replace(classifiers.SPECS["dt"], train_rows=200), ml_source(t, "dt"), keep=t._keep)
    assert kept == [(False, True)] * 2
