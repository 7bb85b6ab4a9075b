"""Joins with checks, unions, lookups, top rows and nearest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import dot, unit
from ..plans.ordering import rank_table, running_sums


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    return repeated.limit(1).count() == 0


def join_validated(left: DataFrame, right: DataFrame, left_key: str, right_key: str, validate: str = "1:1", how: str = "left"):
    """Join on differently named keys after checking the sides that must be unique (``1:1``, ``m:1``, ``1:m``)."""
    if validate[0] == "1" and not is_unique(left, [left_key]):
        raise ValueError(f"{left_key} is not unique on the left side")
    if validate[-1] == "1" and not is_unique(right, [right_key]):
        raise ValueError(f"{right_key} is not unique on the right side")
    side = right if left_key == right_key else right.withColumnRenamed(right_key, left_key)
    return left.join(side, left_key, how)


def concat_columns(frames: Sequence[DataFrame], key: str, how: str = "left") -> DataFrame:
    """Columns of aligned frames side by side, aligned by key."""
    return reduce(lambda a, b: a.join(b, key, how), frames)


def lookup(df: DataFrame, column: str, mapping: Mapping, name: str) -> DataFrame:
    """A fixed dictionary applied to a column; values without an entry become null."""
    expr = None
    for key, value in mapping.items():
        expr = F.when(F.col(column) == key, F.lit(value)) if expr is None else expr.when(F.col(column) == key, F.lit(value))
    return df.withColumn(name, expr)


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    """Row union by name; columns one side lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_by_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the column and rows without it."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def top_k(df: DataFrame, column: str, k: int, minimum: float | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest rows above a minimum."""
    rows = df if minimum is None else df.filter(F.col(column) > minimum)
    return rows.orderBy(F.col(column).desc(), *tie).limit(k)


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)


def nearest(df: DataFrame, vector: str, query: Sequence[float], k: int, key: str) -> DataFrame:
    """The ``k`` rows whose direction is closest to one query vector."""
    target = unit(F.array(*[F.lit(float(x)) for x in query]))
    return df.withColumn("score", dot(unit(vector), target)).orderBy(F.col("score").desc(), key).limit(k)


def cumulative_share(df: DataFrame, column: str, key: str) -> DataFrame:
    """Share of the total and running share, largest first."""
    run = running_sums(df, [F.col(column).desc(), F.col(key)], [column])
    return run.select(
        *df.columns,
        (F.col(column) / F.col(f"tot_{column}")).alias("share"),
        (F.col(f"cum_{column}") / F.col(f"tot_{column}")).alias("cumulative"),
    )


def dense_rank_desc(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their dense rank, largest first."""
    return rank_table(df, column, descending=True).select(column, F.col("rank_dense").alias("dense_rank"), "n")
