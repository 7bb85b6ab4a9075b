"""Features of a parent built from its children over a set of related tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import adjusted_skew
from .columns import categorical_cols, numeric_cols

NUMERIC = {
    "sum": lambda c: F.coalesce(F.sum(c).cast("double"), F.lit(0.0)),
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_samp,
    "skew": adjusted_skew,
}


@dataclass(frozen=True)
class Relation:
    parent: str
    parent_key: str
    child: str
    child_key: str


def deep_features(
    entities: Mapping[str, DataFrame],
    relations: Sequence[Relation],
    target: str,
    primitives: Sequence[str] = ("sum", "mean", "max", "min", "std", "skew", "count", "nunique", "mode"),
    depth: int = 2,
) -> DataFrame:
    """Bottom-up aggregation: each child, with the features it got from its own children, is summarised per parent key
    and joined to the parent. Columns are called ``<primitive>__<child>__<column>``."""
    out = entities[target]
    if depth == 0:
        return out
    keys = {r.parent_key for r in relations if r.parent == target} | {r.child_key for r in relations if r.child == target}
    for r in (r for r in relations if r.parent == target):
        child = deep_features(entities, relations, r.child, primitives, depth - 1)
        links = {x.parent_key for x in relations if x.parent == r.child} | {x.child_key for x in relations if x.child == r.child}
        out = out.join(_summary(child, r, links - keys, primitives).withColumnRenamed(r.child_key, r.parent_key), r.parent_key, "left")
    return out


def _summary(child: DataFrame, r: Relation, links: set[str], primitives: Sequence[str]) -> DataFrame:
    rows = child.filter(F.col(r.child_key).isNotNull())
    skip = links | {r.child_key}
    aggs = [
        NUMERIC[p](c).alias(f"{p}__{r.child}__{c}")
        for c in numeric_cols(child)
        if c not in skip
        for p in primitives
        if p in NUMERIC
    ]
    if "count" in primitives:
        aggs.append(F.count(F.lit(1)).alias(f"count__{r.child}"))
    out = rows.groupBy(r.child_key).agg(*aggs) if aggs else rows.select(r.child_key).distinct()
    for c in categorical_cols(child):
        picks = []
        if "nunique" in primitives:
            picks.append(F.count("__v").alias(f"nunique__{r.child}__{c}"))
        if "mode" in primitives:
            picks.append(F.min(F.when(F.col("__v").isNotNull(), F.struct(-F.col("__n"), F.col("__v")))).getField("__v").alias(f"mode__{r.child}__{c}"))
        if picks:
            counts = rows.groupBy(r.child_key, F.col(c).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
            out = out.join(counts.groupBy(r.child_key).agg(*picks), r.child_key, "left")
    return out
