"""K-means on customer RFM: capping, scaling, k sweep, final model, profiles."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from emporia.functions.columns import pct_of, round_half_up
from emporia.models.stages import build_pipeline, sample_by_key
from emporia.operators.rfm import cap_at_quantile

RFM_FEATURES = ["recency_days", "frequency", "monetary"]
SWEEP = range(2, 9)
FINAL_K = 4
SEED = 42

# Cluster labelling thresholds on the cluster averages.
CHAMPION_MAX_RECENCY = 30
CHAMPION_MIN_FREQUENCY = 5
LOYAL_MIN_FREQUENCY = 3
LOST_MIN_RECENCY = 100


@dataclass
class ClusterRun:
    scaled: DataFrame
    caps: dict
    sweep: DataFrame
    assignments: DataFrame
    silhouette: float
    inertia: float


def scaled_rfm(rfm_ml: DataFrame, q: float = 0.99, rows_in_task: int | None = None) -> tuple[DataFrame, dict]:
    """Cap R, F, M at their exact q-quantile, assemble and min-max scale."""
    kw = {} if rows_in_task is None else {"rows_in_task": rows_in_task}
    capped, caps = cap_at_quantile(rfm_ml, RFM_FEATURES, q, exact=True, **kw)
    capped = capped.withColumns({c: F.col(c).cast("double") for c in RFM_FEATURES})
    prep = build_pipeline(RFM_FEATURES, [], None, scale="minmax")
    return prep.fit(capped).transform(capped), caps


def _sweep_point(scaled: DataFrame, k: int) -> tuple:
    m = KMeans(featuresCol="features", k=k, seed=SEED, maxIter=50).fit(scaled)
    ev = ClusteringEvaluator(featuresCol="features", metricName="silhouette")
    return k, float(m.summary.trainingCost), float(ev.evaluate(m.transform(scaled)))


def run(spark: SparkSession, rfm_ml: DataFrame, ks=SWEEP, final_k: int = FINAL_K,
        rows_in_task: int | None = None, parallelism: int = 4, keep=None) -> ClusterRun:
    """Sweep k (inertia and silhouette per k), then fit the final model.

    The sweep's fits are independent and seeded; they run from a few driver
    threads at once over the persisted, scaled input. ``keep(df, name)``
    stores the assignments; nothing stays cached afterwards.
    """
    scaled, caps = scaled_rfm(rfm_ml, rows_in_task=rows_in_task)
    scaled = scaled.persist()
    scaled.count()
    ev = ClusteringEvaluator(featuresCol="features", metricName="silhouette")
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = sorted(pool.map(lambda k: _sweep_point(scaled, k), list(ks)))
    sweep = spark.createDataFrame(rows, StructType([StructField("k", LongType()), StructField("inertia", DoubleType()),
                                                    StructField("silhouette", DoubleType())]))
    final = KMeans(featuresCol="features", k=final_k, seed=SEED, maxIter=100).fit(scaled)
    assigned = final.transform(scaled)
    silhouette, inertia = float(ev.evaluate(assigned)), float(final.summary.trainingCost)
    assigned = assigned.drop("raw_features", "features")
    assigned = keep(assigned, "cluster_assignments") if keep else assigned
    scaled.unpersist()
    return ClusterRun(scaled, caps, sweep, assigned, silhouette, inertia)


def profile(assignments: DataFrame, key: str = "Customer ID") -> DataFrame:
    """Customers and rounded average R, F, M per cluster."""
    return (assignments.groupBy("prediction").agg(
        F.count(F.col(f"`{key}`")).alias("customer_count"),
        round_half_up(F.avg("recency_days"), 1).alias("avg_recency"),
        round_half_up(F.avg("frequency"), 2).alias("avg_frequency"),
        round_half_up(F.avg("monetary"), 2).alias("avg_monetary"))
        .orderBy("prediction"))


def label_clusters(profile_df: DataFrame) -> DataFrame:
    """Business label per cluster from its averages and the median cluster spend.

    The median is taken over the k profile rows (k is small), in a window
    over that tiny table.
    """
    med = F.median("avg_monetary").over(Window.partitionBy())
    lab = (F.when((F.col("avg_recency") < CHAMPION_MAX_RECENCY) & (F.col("avg_frequency") > CHAMPION_MIN_FREQUENCY),
                  "Champions")
           .when((F.col("avg_monetary") > F.col("_med")) & (F.col("avg_frequency") > LOYAL_MIN_FREQUENCY),
                 "Loyal Customers")
           .when(F.col("avg_recency") > LOST_MIN_RECENCY, "Lost / At Risk")
           .otherwise("Occasional Buyers"))
    return profile_df.withColumn("_med", med).withColumn("segment_label", lab).drop("_med")


def labelled_assignments(assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Every customer with its cluster label (labels hold one row per cluster)."""
    return assignments.join(F.broadcast(labels.select("prediction", "segment_label")), "prediction", "left")


def cluster_share(labels: DataFrame) -> DataFrame:
    """Share of customers per cluster, from the profile rows."""
    total = F.sum("customer_count").over(Window.partitionBy())
    return labels.select("prediction", "segment_label", "customer_count",
                         pct_of(F.col("customer_count"), total, 1).alias("share_pct"))


def display_sample(df: DataFrame, fraction: float = 0.25, key: str = "Customer ID") -> DataFrame:
    """The customers of about ``fraction`` of the keys, for plotting (a sampling operator)."""
    return sample_by_key(df, fraction, key)
