"""Out-of-fold assembly and blending of predictions kept as a long table (id, fold, model, prediction)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import argmax
from ..plans.ordering import attach_ranks
from .relational import union_all


def oof_table(folds: Sequence[tuple[int, str, DataFrame]], key: str, prediction: str) -> DataFrame:
    """Union of fold predictions: (fold, model, frame) parts to one long table."""
    parts = [df.select(key, F.lit(fold).alias("fold"), F.lit(model).alias("model"), F.col(prediction).alias("p")) for fold, model, df in folds]
    return union_all(*parts)


def rank_scaled(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "rank_scaled", salt_on=None) -> DataFrame:
    """``(1 + average rank) / (n + 1)`` within groups."""
    ranked = attach_ranks(df, column, by, salt_on=salt_on)
    return ranked.withColumn(name, (1 + F.col("rank_avg")) / (F.col("total") + 1)).drop("rank_avg", "total")


def blend(df: DataFrame, key: str, p: str, method: str = "mean", fold: str = "fold", name: str = "prediction") -> DataFrame:
    """Fold predictions per id by mean, geometric mean (0 when a prediction is 0) or mean scaled rank within folds."""
    if method == "mean":
        return df.groupBy(key).agg(F.avg(p).alias(name))
    if method == "gmean":
        log_mean = F.exp(F.avg(F.when(F.col(p) > 0, F.ln(p))))
        return df.groupBy(key).agg(F.when(F.min(p) > 0, log_mean).otherwise(F.lit(0.0)).alias(name))
    if method == "rank_mean":
        return rank_scaled(df, p, [fold], "__rank", salt_on=[key]).groupBy(key).agg(F.avg("__rank").alias(name))
    raise ValueError(f"unknown blending method {method}")


def average_models(df: DataFrame, key: str, p: str, name: str = "prediction") -> DataFrame:
    """Mean of all models' outputs per id."""
    return df.groupBy(key).agg(F.avg(p).alias(name))


def soft_vote(df: DataFrame, key: str, model: str, probs: str, weights: Mapping[str, float]) -> DataFrame:
    """Weighted mean of class probabilities per id and its largest class."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    weight = F.lit(0.0)
    for m, w in weights.items():
        weight = F.when(F.col(model) == m, F.lit(float(w))).otherwise(weight)
    rows = df.select(key, array_to_vector(F.col(probs).cast("array<double>")).alias("v"), weight.alias("w"))
    mean = Summarizer.metrics("mean").summary(F.col("v"), F.col("w"))
    out = rows.groupBy(key).agg(vector_to_array(mean.getField("mean")).alias("probs"))
    return out.withColumn("prediction", argmax("probs"))


def stack_features(df: DataFrame, key: str, model: str, probs: str) -> DataFrame:
    """Class probabilities of all models of an id, in model order, as one feature array."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(model).alias("m"), F.col(probs).cast("array<double>").alias("v"))))
    return df.groupBy(key).agg(F.flatten(F.transform(parts, lambda s: s["v"])).alias("features"))


def model_agreement(df: DataFrame, key: str, model: str, p: str, models: Sequence[str]) -> DataFrame:
    """Correlation of the predictions of model pairs."""
    from .profile import corr_matrix

    return corr_matrix(df.groupBy(key).pivot(model, list(models)).agg(F.first(p)), models)
