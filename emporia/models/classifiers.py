"""The four classifiers: specification, training and scoring."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.sql import DataFrame

from emporia.models.prep import ROW_KEY, model_frame
from emporia.models.stages import build_pipeline, key_bucket, sample_by_key
from emporia.plans.session import ensure_checkpoint_dir


@dataclass
class ModelSpec:
    name: str
    numeric: list[str]
    categorical: list[str]
    label: str
    scale: str | None
    make: object          # () -> estimator
    top_k: int
    key: tuple[str, ...] = ("order_id",)      # rows are split and sampled by it
    train_share: float = 1.0                  # share of the training keys that is used; 1 uses all
    train_rows: int | None = None             # the fit sees about so many training rows at most; None: all


# Features, labels and hyper-parameters of the four models.
SPECS = {
    "lr": ModelSpec(
        "Logistic Regression",
        ["items_total_freight", "items_total_price", "days_to_approve", "product_weight_g", "product_volume_cm3",
         "items_count", "max_payment_installments", "avg_item_price"],
        ["customer_state", "seller_state"], "is_late_delivery", "standard",
        lambda label: LogisticRegression(labelCol=label, featuresCol="features", maxIter=100, regParam=0.01,
                                         elasticNetParam=0.0), 10),
    "rf": ModelSpec(
        "Random Forest",
        ["delivery_delay_days", "actual_delivery_days", "total_order_value", "items_total_freight",
         "product_weight_g", "items_count", "max_payment_installments", "days_to_approve"],
        ["product_category_name_english", "primary_payment_type", "customer_state"], "is_high_review", None,
        lambda label: RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=100, maxDepth=8,
                                             seed=42), 12),
    "dt": ModelSpec(
        "Decision Tree",
        ["total_payment_value", "max_payment_installments", "items_count", "items_total_freight",
         "items_total_price", "avg_item_price"],
        ["customer_state", "primary_payment_type"], "is_delivered", None,
        lambda label: DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=10, seed=42), 10),
    "gbt": ModelSpec(
        "GBT",
        ["Quantity", "Price", "InvoiceHour", "InvoiceMonth", "InvoiceDayOfWeek"],
        ["Country"], "is_high_value", None,
        lambda label: GBTClassifier(labelCol=label, featuresCol="features", maxIter=50, maxDepth=5, stepSize=0.1,
                                    seed=42), 10, ("Invoice", "StockCode")),
}

# The boosted trees fitted on at most so many training rows, as an option for large tables.
GBT_TRAIN_ROWS = 200_000
SPECS_SAMPLED = {"gbt_sampled": replace(SPECS["gbt"], name="GBT (sampled)", train_rows=GBT_TRAIN_ROWS)}


@dataclass
class FittedModel:
    spec: ModelSpec
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    cache: dict = field(default_factory=dict)

    @property
    def estimator(self):
        return self.model.stages[-1]

    def assembled_column(self) -> str:
        return "raw_features" if self.spec.scale else "features"


def train(spec: ModelSpec, source: DataFrame, train_pct: int = 80, seed: int = 42, keep=None) -> FittedModel:
    """Select the model's columns, drop incomplete rows, split by key, fit, score.

    ``spec.train_share`` below 1 fits on the rows of that share of the training
    keys, ``spec.train_rows`` on the share that gives about so many rows; the
    test rows are all scored. ``keep(df, name)`` stores the scored rows, which
    every metric table reads; nothing stays cached afterwards.
    """
    frame = model_frame(source, spec.numeric, spec.categorical, spec.label, list(spec.key))
    # The side of each row is part of the cached frame, so no pass of a fit hashes the keys again. Only the first passes
    # read the frame; it stays on disk, so that memory is left to the fit's own rows, which every later pass reads.
    data = frame.withColumn("_side", key_bucket(ROW_KEY, 100, seed) < train_pct).persist(StorageLevel.DISK_ONLY)
    tr, te = data.filter("_side").drop("_side"), data.filter("NOT _side").drop("_side")
    share = spec.train_share
    if spec.train_rows is not None:
        share = min(share, spec.train_rows / max(1, tr.count()))
    used = tr if share >= 1 else sample_by_key(tr, share).persist(StorageLevel.DISK_ONLY)
    model = build_pipeline(spec.numeric, spec.categorical, spec.make(spec.label), spec.scale).fit(used)
    # Scored by the saved model: a fitted one carries its training summary, and with it the session, into every task,
    # which Spark 4.1 cannot send once the session has observed a frame.
    path = f"{ensure_checkpoint_dir(source.sparkSession).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    scored = PipelineModel.load(path).transform(te)
    scored = keep(scored, f"scored_{spec.name.lower().replace(' ', '_')}") if keep else scored
    used.unpersist()
    data.unpersist()
    return FittedModel(spec, model, tr, te, scored)
