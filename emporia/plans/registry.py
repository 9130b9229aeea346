"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's test tables under ``sf_dir`` through the
adapter, so its work grows with the tables. Outputs pass through
``to_edge_types`` so integers are BIGINT, decimals DOUBLE and timestamps text,
the types the SQL check compares.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, IntegerType, ShortType, TimestampNTZType, TimestampType,
)

from emporia.models import cluster as MK
from emporia.models import evaluate as MV
from emporia.functions.columns import round_half_up
from emporia.models.classifiers import SPECS
from emporia.models.prep import model_frame, prep_orders_ml
from emporia.models.stages import build_pipeline, feature_names, hash_split, key_bucket, sample_by_key
from emporia.operators import clean as C
from emporia.operators import profile as P
from emporia.operators import reports
from emporia.operators import rfm as R
from emporia.operators import sketches
from emporia.operators.rfm_state import RfmState, Scored
from emporia.plans.batch_job import named_tables, orders_by_year, summaries
from emporia.plans.session import ensure_checkpoint_dir
from emporia.plans.tables import ORDER_PARTS, CommerceTables, clusters, fitted, from_testdata, ml_source
from emporia.sources.files import load_sound_csv
from emporia.sources.schemas import CATALOGUE
from emporia.sources.sinks import export_all, write_parquet

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def to_edge_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, DecimalType):
            c = c.cast("double")
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        elif isinstance(t, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(cols)


def _tables(spark: SparkSession, sf_dir: str) -> CommerceTables:
    return from_testdata(spark, sf_dir)


def _question(fn, source: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _tables(spark, sf_dir)
        src = {"mf": lambda: t.master_featured, "rfm": lambda: t.rfm_olist, "rf": lambda: t.retail_featured,
               "rfm_base": lambda: t.rfm_base, "lines": lambda: t.retail_lines, "cells": lambda: t.summary_cells}[source]()
        return to_edge_types(fn(src))
    return run


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _question(fn, src) for name, (src, fn) in reports.QUESTIONS.items()
} | {name: _question(fn, "cells") for name, fn in reports.FROM_CELLS.items()}


# Q5 under the original score orientation (score 1 = best), next to the default.
REGISTRY["q05_segments_as_coded"] = lambda spark, sf_dir: to_edge_types(
    reports.q05_segments(_tables(spark, sf_dir).rfm_olist_as_coded))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


# -- tables and profiles ------------------------------------------------------


NULLABLE_COUNTS = ["items_count", "max_payment_installments", "payment_methods_count"]
# Tables profiled, and order columns summarised.
PROFILED = ["orders", "customers", "order_items", "payments", "reviews", "products", "sellers", "retail"]
DESCRIBE_COLS = ["delivery_delay_days", "actual_delivery_days", "days_to_approve", "total_order_value",
                 "review_score", "items_count", "product_weight_g"]


# Names in the report on nulls after cleaning. Payments and reviews are reported per order.
CLEAN_NAMES = {"orders": "orders_clean", "customers": "customers_clean", "order_items": "order_items_clean",
               "products": "products_clean", "sellers": "sellers_clean", "retail": "retail_clean"}


# The reports on cleaning are read from the counts that the cleaning passes have taken.

def _row_counts(t: CommerceTables) -> DataFrame:
    rows = [(n, t.counts(n)["raw_rows"]) for n in PROFILED]
    return P.with_total(t.spark.createDataFrame(rows, "table_name string, row_count long"))


def _null_profile(t: CommerceTables) -> DataFrame:
    rows = [(n, c, t.counts(n)["raw_nulls", c], t.counts(n)["raw_rows"]) for n in PROFILED for c in t.raw[n].columns]
    return P.null_shares(t.spark.createDataFrame(rows, "table_name string, column_name string, null_count long, _rows long"))


def _null_total(t: CommerceTables) -> DataFrame:
    rows = [(name, t.counts(n)["clean_rows"], sum(v for k, v in t.counts(n).items() if k[0] == "nulls"))
            for n, name in CLEAN_NAMES.items()]
    counted = t.spark.createDataFrame(rows, "table_name string, row_count long, total_nulls long")
    return _union([counted, P.null_total(t.payments_agg, "payments_agg"), P.null_total(t.reviews_latest, "reviews_dedup")])


def _clean_report(t: CommerceTables) -> DataFrame:
    rows = [(n, t.counts(n)["raw_rows"], t.reviews_latest.count() if n == "reviews" else t.counts(n)["clean_rows"]) for n in PROFILED]
    return P.dropped_shares(t.spark.createDataFrame(rows, "table_name string, raw_rows long, clean_rows long"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _table_query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_edge_types(build(_tables(spark, sf_dir)))
    return run


def _capped(t: CommerceTables) -> DataFrame:
    capped, _ = R.cap_at_quantile(t.rfm_retail_ml, ["recency_days", "frequency", "monetary"], 0.99, exact=True,
                                  rows_in_task=t.rows_in_task)
    return capped


TABLE_QUERIES = {
    "row_counts": _row_counts,
    "null_profile": _null_profile,
    "null_total": _null_total,
    "clean_report": _clean_report,
    "rejected_rows": lambda t: t.rejected_rows(),
    "describe_orders": lambda t: P.describe(t.master_featured, DESCRIBE_COLS),
    "clean_orders": lambda t: t.orders_clean,
    "clean_customers": lambda t: t.customers_clean,
    "dedup_items": lambda t: t.items_clean,
    "payments_agg": lambda t: t.payments_agg,
    "items_agg": lambda t: t.items_agg,
    "latest_review": lambda t: t.reviews_latest,
    "products_translated": lambda t: t.products_clean,
    "clean_sellers": lambda t: t.sellers_clean,
    "clean_payments": lambda t: t.payments_clean,
    "clean_reviews": lambda t: t.reviews_clean,
    "category_clean": lambda t: t.category_clean,
    "rfm_retail_ml": lambda t: t.rfm_retail_ml,
    # Counts that are null for orders without items/payments travel as doubles,
    # the one numeric type whose nulls both engines hand over the same way.
    "master_featured": lambda t: t.master_featured.withColumns(
        {c: F.col(c).cast("double") for c in NULLABLE_COUNTS}),
    "retail_clean": lambda t: t.retail_clean,
    "retail_featured": lambda t: t.retail_featured,
    "rfm_orders_best_high": lambda t: t.rfm_olist,
    "rfm_orders_as_coded": lambda t: t.rfm_olist_as_coded,
    "rfm_retail": lambda t: t.rfm_retail,
    "segment_counts": lambda t: (t.rfm_olist.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("count"))
                                 .orderBy(F.desc("count"), "customer_segment")),
    "rfm_capped_exact": _capped,
    "class_balance": lambda t: P.class_balance(prep_orders_ml(t.master_featured), "is_late_delivery"),
    "class_balance_review": lambda t: P.class_balance(prep_orders_ml(t.master_featured), "is_high_review"),
    "class_balance_retail": lambda t: P.class_balance(t.retail_featured, "is_high_value"),
}

REGISTRY.update({name: _table_query(fn) for name, fn in TABLE_QUERIES.items()})


# -- models (no SQL form: checked by row counts and invariant tests) -----------


MODEL_KEYS = ["lr", "rf", "dt", "gbt"]


def _metrics(t: CommerceTables, key: str) -> DataFrame:
    f = fitted(t, key)
    if "metrics" not in f.cache:
        f.cache["metrics"] = MV.binary_metrics(t.spark, f.predictions, f.spec.label, f.spec.name)
    return f.cache["metrics"]


def _weights(t: CommerceTables, key: str) -> DataFrame:
    f = fitted(t, key)
    names = feature_names(f.predictions, f.assembled_column())
    if key == "lr":
        return MV.top_weights(t.spark, f.spec.name, names, f.estimator.coefficients.toArray(), f.spec.top_k,
                              True, "coefficient")
    return MV.top_weights(t.spark, f.spec.name, names, f.estimator.featureImportances.toArray(), f.spec.top_k,
                          False, "importance")


def _importance_by_source(t: CommerceTables, key: str) -> DataFrame:
    f = fitted(t, key)
    names = feature_names(f.predictions, f.assembled_column())
    df = MV.top_weights(t.spark, f.spec.name, names, f.estimator.featureImportances.toArray(), len(names),
                        False, "importance")
    source = F.regexp_extract("feature", r"^(.*)_ohe_", 1)
    return (df.withColumn("source", F.when(source == "", F.col("feature")).otherwise(source))
            .groupBy("model", "source").agg(F.sum("importance").alias("importance")))


def _roc(t: CommerceTables) -> DataFrame:
    return _union([MV.roc_points(fitted(t, k).predictions, fitted(t, k).spec.label, fitted(t, k).spec.name)
                   for k in MODEL_KEYS])


def _comparison(t: CommerceTables) -> DataFrame:
    clf = _union([_metrics(t, k) for k in MODEL_KEYS]).withColumns(
        {"silhouette": F.lit(None).cast("double"), "inertia": F.lit(None).cast("double"),
         "k": F.lit(None).cast("bigint")})
    c = clusters(t)
    km = (t.spark.range(1).select(F.lit(MK.FINAL_K).cast("bigint").alias("k"))
          .select(F.lit("K-Means").alias("model"), *[F.lit(None).cast("double").alias(m) for m in
                                                      ["accuracy", "precision", "recall", "f1", "auc_roc"]],
                  F.lit(c.silhouette).alias("silhouette"), F.lit(c.inertia).alias("inertia"), "k"))
    return clf.unionByName(km)


def _cluster_labels(t: CommerceTables) -> DataFrame:
    return MK.label_clusters(MK.profile(clusters(t).assignments))


MODEL_QUERIES = {
    "lr_metrics": lambda t: _metrics(t, "lr"),
    "rf_metrics": lambda t: _metrics(t, "rf"),
    "dt_metrics": lambda t: _metrics(t, "dt"),
    "gbt_metrics": lambda t: _metrics(t, "gbt"),
    "gbt_sampled_metrics": lambda t: _metrics(t, "gbt_sampled"),
    "confusion_matrix": lambda t: _union([MV.confusion_matrix(fitted(t, k).predictions, fitted(t, k).spec.label,
                                                              fitted(t, k).spec.name) for k in MODEL_KEYS]),
    "roc_points": _roc,
    "roc_area": lambda t: MV.roc_area(_roc(t)),
    "roc_area_exact": lambda t: _union([MV.exact_area(MV.ranked_scores(fitted(t, k).predictions, fitted(t, k).spec.label, t._keep),
                                                      fitted(t, k).spec.name) for k in MODEL_KEYS]),
    "lr_loss": lambda t: MV.series(t.spark, "Logistic Regression",
                                   fitted(t, "lr").estimator.summary.objectiveHistory, "objective"),
    "gbt_loss": lambda t: MV.series(t.spark, "GBT", fitted(t, "gbt").estimator.evaluateEachIteration(
        fitted(t, "gbt").predictions), "log_loss"),
    "lr_coefficients": lambda t: _weights(t, "lr"),
    "rf_importances": lambda t: _weights(t, "rf"),
    "dt_importances": lambda t: _weights(t, "dt"),
    "gbt_importances": lambda t: _weights(t, "gbt"),
    "rf_importance_by_column": lambda t: _importance_by_source(t, "rf"),
    "kmeans_sweep": lambda t: clusters(t).sweep,
    "kmeans_profile": lambda t: MK.profile(clusters(t).assignments),
    "kmeans_labels": _cluster_labels,
    "kmeans_assignments": lambda t: MK.labelled_assignments(clusters(t).assignments, _cluster_labels(t)),
    "kmeans_share": lambda t: MK.cluster_share(_cluster_labels(t)),
    "kmeans_display_sample": lambda t: MK.display_sample(
        MK.labelled_assignments(clusters(t).assignments, _cluster_labels(t))),
    "model_comparison": _comparison,
    "label_balance": lambda t: _union([P.class_balance(fitted(t, k).train, fitted(t, k).spec.label)
                                       .withColumn("model", F.lit(fitted(t, k).spec.name)) for k in MODEL_KEYS]),
}

REGISTRY.update({name: _table_query(fn) for name, fn in MODEL_QUERIES.items()})

# Approximate statistics have no exact SQL twin: rows-only.
REGISTRY["summary_orders"] = _table_query(lambda t: P.describe(t.master_featured, DESCRIBE_COLS, quartiles=True))
REGISTRY["describe_ml_orders"] = _table_query(lambda t: P.describe(
    prep_orders_ml(t.master_featured), ["is_late_delivery", "is_high_review", "is_delivered"]))
# The exact frame each classifier trains on (before the split): SQL-checkable.
def _model_frame(key: str):
    spec = SPECS[key]
    return _table_query(lambda t: model_frame(ml_source(t, key), spec.numeric, spec.categorical, spec.label))


for _key in ("lr", "rf", "dt", "gbt"):
    REGISTRY[f"ml_frame_{_key}"] = _model_frame(_key)


GBT_TRAIN_SHARE = 0.25      # the optional down-sampling step of the boosted trees, as a share of the keys


def _gbt_sample_balance(t: CommerceTables) -> DataFrame:
    """The optional down-sampling step (a sampling operator): label balance of the sampled GBT frame."""
    spec = SPECS["gbt"]
    frame = model_frame(ml_source(t, "gbt"), spec.numeric, spec.categorical, spec.label, list(spec.key))
    return P.class_balance(sample_by_key(frame, GBT_TRAIN_SHARE), spec.label)


REGISTRY["gbt_sample_balance"] = _table_query(_gbt_sample_balance)


def _keyed_frame(t: CommerceTables, key: str) -> DataFrame:
    spec = SPECS[key]
    return model_frame(ml_source(t, key), spec.numeric, spec.categorical, spec.label, list(spec.key))


def _split_sizes(t: CommerceTables) -> DataFrame:
    """Rows of each model's training and test part."""
    parts = []
    for key, spec in SPECS.items():
        for name, part in zip(("train", "test"), hash_split(_keyed_frame(t, key)), strict=True):
            parts.append(part.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(spec.name).alias("model"), F.lit(name).alias("part"), "row_count"))
    return _union(parts)


def _index_labels(t: CommerceTables) -> DataFrame:
    """The index that each model's string indexer gives to each category of its training rows."""
    rows = []
    for key, spec in SPECS.items():
        train, _ = hash_split(_keyed_frame(t, key))
        indexer = build_pipeline(spec.numeric, spec.categorical).getStages()[0].fit(train)
        for column, labels in zip(spec.categorical, indexer.labelsArray, strict=True):
            rows += [(spec.name, column, value, i) for i, value in enumerate(labels)]
    return t.spark.createDataFrame(rows, "model string, column_name string, value string, idx long")


def _scale_factors(t: CommerceTables) -> DataFrame:
    """Standard deviation of each numeric feature of the scaled model, from its fitted scaler."""
    spec = SPECS["lr"]
    train, _ = hash_split(_keyed_frame(t, "lr"))
    scaler = build_pipeline(spec.numeric, spec.categorical, None, spec.scale).fit(train).stages[-1]
    rows = [(c, float(s)) for c, s in zip(spec.numeric, scaler.std.toArray(), strict=False)]
    return t.spark.createDataFrame(rows, "feature string, std double").select(
        "feature", round_half_up(F.col("std"), 6).alias("std"))


def _rfm_scaled(t: CommerceTables) -> DataFrame:
    """The min-max scaled frame that the clusters are fitted on."""
    scaled, _ = MK.scaled_rfm(t.rfm_retail_ml, rows_in_task=t.rows_in_task)
    v = vector_to_array("features")
    return scaled.select("Customer ID", *[round_half_up(v[i], 6).alias(c) for i, c in enumerate(MK.RFM_FEATURES)])


REGISTRY.update({"split_sizes": _table_query(_split_sizes), "index_labels": _table_query(_index_labels),
                 "scale_factors": _table_query(_scale_factors), "rfm_scaled": _table_query(_rfm_scaled)})

REGISTRY["rfm_capped_approx"] = _table_query(lambda t: R.cap_at_quantile(
    t.rfm_retail_ml, ["recency_days", "frequency", "monetary"], 0.99, exact=False, relative_error=0.001)[0])
REGISTRY["summary_rfm_retail"] = _table_query(lambda t: P.describe(
    t.rfm_retail_ml, ["recency_days", "frequency", "monetary"], quartiles=True))


# -- export (S8-S11) -------------------------------------------------------------


def _export(t: CommerceTables) -> DataFrame:
    """Rows of each export, read back from its files.

    Where the session has not built the featured orders for other queries, the job has tables of its own, and deletes
    each saved one after its last use, so that they do not lie beside the exports.
    """
    own = t if "master_featured" in vars(t) else CommerceTables(t.spark, t.raw, t.rows_in_task, t.materialize, t._buckets)
    release = own.release if own is not t else lambda *names: None
    own.master_featured
    release(*ORDER_PARTS)
    base = ensure_checkpoint_dir(t.spark).rstrip("/") + f"/exports-{t.spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    cells = own.summary_cells
    tables = {k: to_edge_types(v) for k, v in named_tables(own).items()}
    release("retail_clean")
    # The largest export comes last: the shuffle of the retail customers has gone by then.
    tables["online_retail_featured"] = tables.pop("online_retail_featured")
    # All that follows is saved on its own, or is computed from the saved customers and retail lines.
    last_use = {"master_featured": "master_featured", "rfm_olist": "rfm_base", "online_retail_featured": "retail_lines"}
    written = export_all(tables, summaries(cells), base, done=lambda name: release(*[n for k, n in last_use.items() if k == name]))
    return written.select("export", "row_count")


REGISTRY["export_manifest"] = _table_query(_export)


# -- malformed input (S1, S2) -------------------------------------------------------


def _damaged_csv(t: CommerceTables, base: str) -> None:
    """The raw order lines as CSV text; by rule some lines lose fields, get one more, or an open quote."""
    fields = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'))
              if c == "product_id" else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ITEM_COLUMNS]
    line, k = F.concat_ws(",", *fields), F.col("order_id").cast("bigint") + F.col("order_item_id")
    line = (F.when(k % 101 == 0, F.concat_ws(",", *fields[:4])).when(k % 103 == 0, F.concat(line, F.lit(",more")))
            .when(k % 107 == 0, F.concat_ws(",", F.col("order_id"), F.lit('"open'), *fields[2:])).otherwise(line))
    t.raw["order_items"].select(line.alias("value")).write.text(base)


ITEM_COLUMNS = [f.name for f in CATALOGUE["order_items"][1].fields]


def _quarantine(t: CommerceTables) -> DataFrame:
    """Order lines kept and set aside, by reason, after a round trip through a damaged CSV file."""
    base = ensure_checkpoint_dir(t.spark).rstrip("/") + f"/damaged-{uuid.uuid4().hex[:8]}"
    _damaged_csv(t, f"{base}/csv")
    sound, aside = load_sound_csv(t.spark, f"{base}/csv", CATALOGUE["order_items"][1], f"{base}/staged", header=False)
    kept = sound.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("order_item_id")).alias("item_sum"))
    return kept.select(F.lit("kept").alias("reason"), "row_count", "item_sum").unionByName(
        aside.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")).withColumn("item_sum", F.lit(None).cast("long")))


REGISTRY["quarantine_report"] = _table_query(_quarantine)


# -- refresh and upkeep (S8, S9, A3-A5) ----------------------------------------------

REFRESHED = 1997            # the year that is stale at first
BATCHES = 4


def _scratch(t: CommerceTables, name: str) -> str:
    return ensure_checkpoint_dir(t.spark).rstrip("/") + f"/{name}-{t.spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"


def _refresh_years(t: CommerceTables) -> DataFrame:
    """Orders and value by year after one stale year (a quarter of its orders missing) is replaced in the saved table."""
    path = _scratch(t, "refreshed")
    missing = (F.col("order_year") == REFRESHED) & (key_bucket("order_id", BATCHES) == 0)
    write_parquet(t.master_featured.filter(F.coalesce(~missing, F.lit(True))), path, partition_by=["order_year"])
    return orders_by_year(t.spark.read.parquet(t.refresh_years(path, [REFRESHED])))


def _upkeep(t: CommerceTables, rows: DataFrame, scored: Scored, split: str) -> DataFrame:
    """Scores from a state into which the rows were folded in batches, one of them twice, with a compaction between."""
    state = RfmState(t.spark, _scratch(t, "rfm-state"), scored)
    for k in [0, 1, 0]:
        state.fold(rows.filter(key_bucket(split, BATCHES) == k), f"b{k}")
    state = state.compact()
    for k in range(2, BATCHES):
        state.fold(rows.filter(key_bucket(split, BATCHES) == k), f"b{k}")
    return state.rfm()


ORDER_SCORES = Scored("customer_unique_id", "order_id", "order_purchase_timestamp", "total_order_value", "order_status = 'delivered'")
RETAIL_SCORES = Scored("Customer ID", "Invoice", "InvoiceDate", "TotalLineValue", "`Customer ID` <> -1")

REGISTRY.update({
    "refresh_years": _table_query(_refresh_years),
    "rfm_upkeep_orders": _table_query(lambda t: _upkeep(t, t.master_featured, ORDER_SCORES, "order_id")),
    # Lines of one invoice come in several batches.
    "rfm_upkeep_retail": _table_query(lambda t: _upkeep(t, t.retail_lines, RETAIL_SCORES, "StockCode")),
})


# -- stored sketches (A13, A10) ------------------------------------------------------

VALUE_COLUMNS = ["total_order_value", "items_total_freight", "actual_delivery_days"]


def _customer_cells(t: CommerceTables) -> DataFrame:
    if "_customer_cells" not in t.__dict__:
        t.__dict__["_customer_cells"] = t._keep(sketches.customer_cells(t.master_featured), "customer_cells")
    return t.__dict__["_customer_cells"]


def _value_quantiles(t: CommerceTables) -> DataFrame:
    cells = t._keep(sketches.quantile_cells(t.master_featured, ("order_year", "order_month"), VALUE_COLUMNS), "value_cells")
    return sketches.quantiles_by(cells, ["order_year"], VALUE_COLUMNS)


REGISTRY.update({
    "customers_by_state_sketch": _table_query(lambda t: sketches.distinct_by(_customer_cells(t), "order_year", "customer_state")),
    "customers_retained_sketch": _table_query(lambda t: sketches.retained_by(_customer_cells(t), "order_year")),
    "value_quantiles_sketch": _table_query(_value_quantiles),
})
