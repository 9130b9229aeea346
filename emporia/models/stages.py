"""Feature pipelines: index, one-hot encode, assemble, scale, estimate."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.models.prep import ROW_KEY


def build_pipeline(numeric: list[str], categorical: list[str], estimator=None, scale: str | None = None,
                   features_col: str = "features") -> Pipeline:
    """Indexer (unseen values kept) -> one-hot -> assembler [-> scaler] [-> estimator].

    The assembled vector is ``raw_features`` when a scaler follows, so its
    attribute metadata (feature names) stays readable.
    """
    stages = []
    ohe_cols = []
    if categorical:
        idx_cols = [f"{c}_idx" for c in categorical]
        ohe_cols = [f"{c}_ohe" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx_cols, handleInvalid="keep",
                                    stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx_cols, outputCols=ohe_cols))
    assembled = "raw_features" if scale else features_col
    stages.append(VectorAssembler(inputCols=numeric + ohe_cols, outputCol=assembled))
    if scale == "standard":
        stages.append(StandardScaler(inputCol=assembled, outputCol=features_col, withMean=False))
    elif scale == "minmax":
        stages.append(MinMaxScaler(inputCol=assembled, outputCol=features_col))
    elif scale is not None:
        raise ValueError(f"unknown scaler {scale}")
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def key_bucket(key: str, buckets: int, seed: int = 42) -> Column:
    """A bucket from 0 to ``buckets`` - 1 from the key's MD5, which every SQL engine computes alike."""
    text = F.concat_ws("|", F.lit(str(seed)), F.col(f"`{key}`").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, key: str = ROW_KEY, train_pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by a hash of the key.

    Unlike ``randomSplit`` the side of a row does not depend on partitioning
    or on re-computation after a lost task, nor on its other values.
    """
    bucket = key_bucket(key, 100, seed)
    return df.filter(bucket < train_pct), df.filter(bucket >= train_pct)


def sample_by_key(df: DataFrame, fraction: float, key: str = ROW_KEY, seed: int = 43) -> DataFrame:
    """The rows of about ``fraction`` of the keys, the same at every size and partitioning."""
    return df.filter(key_bucket(key, 10_000, seed) < int(round(fraction * 10_000)))


def feature_names(df: DataFrame, vector_col: str) -> list[str]:
    """Slot names of an assembled vector column, from its attribute metadata."""
    attrs = df.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]
