"""Splits, folds, resampling and class weights from key hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import hash_fold, key_hash, key_uniform
from ..plans.ordering import row_numbers
from ..plans.scalars import Scalars
from ..plans.skew import lookup_join


def random_split(df: DataFrame, key: str, ratio: float, seed: str = "split", name: str = "split") -> DataFrame:
    """``train`` for the given share of keys, ``test`` for the rest."""
    return df.withColumn(name, F.when(key_uniform(key, seed) < ratio, "train").otherwise("test"))


def _hash_order(df: DataFrame, key: str, by: Sequence[str], seed: str) -> DataFrame:
    """Rows numbered by key hash within groups of any size."""
    hashed = df.withColumn("__h", key_hash(key, seed))
    return row_numbers(hashed, ["__h", key], by, name="__row").drop("__h")


def stratified_split(df: DataFrame, key: str, y: str, ratio: float, seed: str = "split", name: str = "split") -> DataFrame:
    """Exactly ``round(ratio * n)`` train rows in every class."""
    rows = _hash_order(df.filter(F.col(y).isNotNull()), key, [y], seed)
    sizes = rows.groupBy(y).agg(F.round(F.count(F.lit(1)) * ratio).cast("long").alias("__cut"))
    joined = lookup_join(rows, sizes, [y], salt_on=[key])
    return joined.withColumn(name, F.when(F.col("__row") <= F.col("__cut"), "train").otherwise("test")).drop("__row", "__cut")


def add_fold(df: DataFrame, key: str, k: int, y: str | None = None, seed: str = "", name: str = "fold") -> DataFrame:
    """Fold id from the key; with ``y`` the classes are dealt out evenly over the folds."""
    if y is None:
        return df.withColumn(name, hash_fold(key, k, seed))
    rows = _hash_order(df, key, [y], seed)
    return rows.withColumn(name, ((F.col("__row") - 1) % k).cast("int")).drop("__row")


def shuffle_rows(df: DataFrame, key: str, seed: str = "shuffle") -> DataFrame:
    return df.orderBy(key_hash(key, seed), key)


def append_pseudo(
    train: DataFrame, unlabelled: DataFrame, soft: DataFrame, key: str, ranges: Sequence[tuple[int, int | None]], label: str = "label"
) -> DataFrame:
    """Training rows plus the unlabelled rows of the key ranges (no upper end: all from there on) with their soft labels."""
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | ((F.col(key) >= low) & (F.lit(True) if high is None else F.col(key) < high))
    added = unlabelled.filter(inside).join(soft.select(key, label), key)
    return train.withColumn("pseudo", F.lit(0)).unionByName(added.withColumn("pseudo", F.lit(1)), allowMissingColumns=True)


def undersample(
    df: DataFrame, key: str, y: str, counts: Mapping | None = None, multipliers: Mapping | None = None, seed: str = "under"
) -> DataFrame:
    """At most the given number of rows per class, or ``int(multiplier * n)``; classes not named are kept whole."""
    rows = _hash_order(df, key, [y], seed)
    if counts is not None:
        limit = _by_class(y, counts)
        kept = rows.filter(limit.isNull() | (F.col("__row") <= limit))
    else:
        sizes = rows.groupBy(y).agg(F.count(F.lit(1)).alias("__n"))
        limit = F.floor(F.col("__n") * _by_class(y, multipliers or {}))
        kept = lookup_join(rows, sizes, [y], salt_on=[key]).filter(limit.isNull() | (F.col("__row") <= limit)).drop("__n")
    return kept.drop("__row")


def _by_class(y: str, values: Mapping) -> Column:
    expr = F.lit(None).cast("double")
    for key, value in values.items():
        expr = F.when(F.col(y) == key, F.lit(float(value))).otherwise(expr)
    return expr


def class_weights(df: DataFrame, y: str, name: str = "weight", fixed: Mapping | None = None) -> DataFrame:
    """Weight per row: ``n / (classes * class size)``, or fixed weights by class (1 where none is given)."""
    if fixed is not None:
        return df.withColumn(name, F.coalesce(_by_class(y, fixed), F.lit(1.0)))
    counts = df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("__n"))
    s = Scalars(counts, total=F.sum("__n"), classes=F.count(F.lit(1)))
    return lookup_join(df, counts.select(y, (s["total"] / (s["classes"] * F.col("__n"))).alias(name)), [y])
