"""Evaluation tables for classifiers; every table is computed on the executors."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

METRICS_SCHEMA = StructType([
    StructField("model", StringType()), StructField("accuracy", DoubleType()),
    StructField("precision", DoubleType()), StructField("recall", DoubleType()),
    StructField("f1", DoubleType()), StructField("auc_roc", DoubleType()),
])


def binary_metrics(spark: SparkSession, predictions: DataFrame, label: str, model: str) -> DataFrame:
    """One row: accuracy, weighted precision / recall, F1 and area under ROC.

    All but the area follow from the four confusion cells, one pass.
    """
    cells = {(r["label"], r["prediction"]): r["count"] for r in confusion_matrix(predictions, label, model).collect()}
    total = sum(cells.values())
    scores = {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    for c in (0, 1):
        actual = sum(n for (y, _), n in cells.items() if y == c)
        predicted = sum(n for (_, p), n in cells.items() if p == c)
        hit, weight = cells[c, c], actual / total if total else 0.0
        precision, recall = hit / predicted if predicted else 0.0, hit / actual if actual else 0.0
        scores["accuracy"] += hit / total if total else 0.0
        scores["precision"] += weight * precision
        scores["recall"] += weight * recall
        scores["f1"] += weight * (2 * precision * recall / (precision + recall) if precision + recall else 0.0)
    area = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    return spark.createDataFrame([(model, *scores.values(), area.evaluate(predictions))], METRICS_SCHEMA)


def confusion_matrix(predictions: DataFrame, label: str, model: str) -> DataFrame:
    """(model, label, prediction, count) for all four cells of a binary model (0 when empty)."""
    counts = (predictions.groupBy(F.col(label).cast("int").alias("label"),
                                  F.col("prediction").cast("int").alias("prediction"))
              .agg(F.count(F.lit(1)).alias("count")))
    cells = predictions.sparkSession.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)],
                                                     "label int, prediction int")
    return (cells.join(counts, ["label", "prediction"], "left")
            .select(F.lit(model).alias("model"), "label", "prediction",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def positive_probability(predictions: DataFrame) -> F.Column:
    return vector_to_array("probability")[1]


def roc_points(predictions: DataFrame, label: str, model: str, bins: int = 1000) -> DataFrame:
    """ROC curve on a fixed threshold grid: (model, threshold, tpr, fpr).

    Scores are cut into ``bins`` equal-width bins and aggregated, so only
    ``bins`` rows reach the cumulative window however many predictions exist.
    Every threshold i / bins (i = 0 .. bins) appears, empty bins included, so
    the table has ``bins + 1`` rows per model; threshold 1 is the (0, 0) start.
    """
    p = positive_probability(predictions)
    b = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("long")
    per_bin = (predictions.select(b.alias("bin"), F.col(label).cast("long").alias("y"))
               .groupBy("bin").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
    grid = predictions.sparkSession.range(bins + 1).withColumnRenamed("id", "bin")
    filled = grid.join(per_bin, "bin", "left").fillna({"pos": 0, "neg": 0})
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    # A class absent from the test rows gives null rates instead of a division error.
    return filled.select(
        F.lit(model).alias("model"),
        (F.col("bin") / bins).alias("threshold"),
        (F.sum("pos").over(down) / F.nullif(F.sum("pos").over(whole), F.lit(0))).alias("tpr"),
        (F.sum("neg").over(down) / F.nullif(F.sum("neg").over(whole), F.lit(0))).alias("fpr"))


def roc_area(points: DataFrame) -> DataFrame:
    """Trapezoid area under the binned ROC points, per model: an approximation at the points' resolution (``bins``)."""
    w = Window.partitionBy("model").orderBy("fpr", "tpr")
    seg = points.select("model", "fpr", "tpr",
                        F.lag("fpr").over(w).alias("f0"), F.lag("tpr").over(w).alias("t0"))
    return (seg.groupBy("model").agg(
        F.sum(F.coalesce((F.col("fpr") - F.col("f0")) * (F.col("tpr") + F.col("t0")) / 2, F.lit(0.0))).alias("auc")))


def ranked_scores(predictions: DataFrame, label: str, keep) -> DataFrame:
    """(score, pos, neg, pos_above, neg_above): the rows of each distinct score, and those with a higher one.

    Tied rows are one row of counts before anything is shuffled. The distinct
    scores are dealt out in ranges, which ``keep(df, name)`` saves, so a range
    keeps its number; sums over a range and over the ranges before it (a row
    each) give the counts above, and no task holds more than a range.
    """
    counts = (predictions.select(positive_probability(predictions).alias("score"), F.col(label).cast("long").alias("y"))
              .groupBy("score").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
    ranges = keep(counts.repartitionByRange(F.desc("score")).withColumn("range", F.spark_partition_id()), "score_ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)      # a row per range
    totals = ranges.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    totals = totals.select("range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in "pn"])
    inside = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = lambda c, t: F.col(t) + F.coalesce(F.sum(c).over(inside), F.lit(0))
    return (ranges.join(F.broadcast(totals), "range")
            .select("score", "pos", "neg", above("pos", "p").alias("pos_above"), above("neg", "n").alias("neg_above")))


def exact_area(ranked: DataFrame, model: str) -> DataFrame:
    """(model, positives, negatives, auc): the share of pairs of a positive and a negative row that the scores order rightly,
    ties counted half; null if a class is absent."""
    doubled = F.sum((F.col("neg") * (2 * F.col("pos_above") + F.col("pos"))).cast("decimal(38,0)"))
    sums = ranked.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), doubled.alias("_d"))
    pairs = F.col("positives").cast("double") * F.col("negatives") * 2
    return sums.select(F.lit(model).alias("model"), "positives", "negatives",
                       (F.col("_d").cast("double") / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def series(spark: SparkSession, model: str, values: list[float], name: str) -> DataFrame:
    """(model, iteration, value) from a per-iteration list held by a fitted model."""
    rows = [(model, i, float(v)) for i, v in enumerate(values)]
    schema = StructType([StructField("model", StringType()), StructField("iteration", LongType()),
                         StructField(name, DoubleType())])
    return spark.createDataFrame(rows, schema)


def top_weights(spark: SparkSession, model: str, names: list[str], weights, k: int, by_abs: bool,
                value_name: str) -> DataFrame:
    """The k largest model weights (by absolute value if ``by_abs``) with feature names."""
    vals = [float(w) for w in weights]
    names = names if len(names) == len(vals) else [f"f{i}" for i in range(len(vals))]
    rows = [(model, n, v) for n, v in zip(names, vals)]
    schema = StructType([StructField("model", StringType()), StructField("feature", StringType()),
                         StructField(value_name, DoubleType())])
    df = spark.createDataFrame(rows, schema)
    key = F.abs(F.col(value_name)) if by_abs else F.col(value_name)
    return df.orderBy(key.desc(), "feature").limit(k)
