"""Reject inference: labels for unlabelled rows drawn from the bad rate of their score band."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import key_uniform
from ..plans.scalars import Scalars
from ..plans.session import materialise
from ..plans.skew import lookup_join
from .encoding import quantile_edges


def _banded(df: DataFrame, score: str, edges: DataFrame, bands: int) -> DataFrame:
    s = Scalars(edges, **{f"e{i}": F.first(f"e{i}") for i in range(bands + 1)})
    code = F.lit(0)
    for i in range(1, bands):
        code = code + F.when(F.col(score) > s[f"e{i}"], 1).otherwise(0)
    return df.withColumn("band", code)


def band_rates(labelled: DataFrame, score: str, y: str, bands: int) -> DataFrame:
    """Rows and bad rate per quantile band of the score on labelled rows."""
    edges = materialise(quantile_edges(labelled, score, bands))
    return _banded(labelled, score, edges, bands).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("bad_rate")
    )


def reject_inference(
    labelled: DataFrame, unlabelled: DataFrame, key: str, score: str, y: str, bands: int = 5, factor: float = 1.0, seed: str = "reject"
) -> DataFrame:
    """Labelled rows, and all unlabelled rows with a label drawn at ``factor`` times the bad rate of their band. The
    outer bands are open, so that every score has one."""
    edges = materialise(quantile_edges(labelled, score, bands))
    rates = _banded(labelled, score, edges, bands).groupBy("band").agg(F.avg(F.col(y).cast("double")).alias("bad_rate"))
    inferred = lookup_join(_banded(unlabelled, score, edges, bands), rates, ["band"], salt_on=[key])
    drawn = (key_uniform(key, seed) < F.col("bad_rate") * factor).cast("int")
    return (
        labelled.select(key, score, F.col(y).cast("int").alias(y), F.lit(0).alias("inferred"))
        .unionByName(inferred.select(key, score, drawn.alias(y), F.lit(1).alias("inferred")))
    )
