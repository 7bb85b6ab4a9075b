"""Recipe-driven group statistics: compiled to one aggregate per key set, fitted once, joined later."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import adjusted_skew
from ..plans.ordering import group_quantiles
from ..plans.session import materialise
from ..plans.skew import attach_groups, lookup_join

SIMPLE: dict[str, Callable[[str], Column]] = {
    "mean": lambda c: F.avg(c),
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0).cast("double")),
    "count": lambda c: F.count(c),
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "std": lambda c: F.stddev_samp(c),
    "var": lambda c: F.var_samp(c),
    "skew": lambda c: adjusted_skew(c),
    "range": lambda c: F.max(c) - F.min(c),
}
# Quantiles behind the named order statistics
QUANTILES = {"median": {"q50": 0.5}, "q_range": {"q99": 0.99, "q01": 0.01}, "q25": {"q25": 0.25}, "q75": {"q75": 0.75}}


@dataclass(frozen=True)
class Recipe:
    """Group keys and the (column, function) pairs to compute on them. A function is a name, or a pair of a name and
    a callable from column to aggregate."""

    keys: tuple[str, ...]
    specs: tuple[tuple[str, object], ...]


def recipe(keys: Sequence[str], specs: Sequence[tuple]) -> Recipe:
    return Recipe(tuple(keys), tuple(dict.fromkeys((c, f) for c, f in specs)))


def feature_name(keys: Sequence[str], column: str, fn: str) -> str:
    return "_".join([*keys, column, fn])


def _fn_name(fn) -> str:
    return fn if isinstance(fn, str) else fn[0]


def group_agg(df: DataFrame, keys: Sequence[str], specs: Sequence[tuple], names=None, accuracy: int | None = None) -> DataFrame:
    """All functions of a key set in one aggregate; rows with a null key are left out.

    Order statistics are exact and stay balanced for groups of any size; ``accuracy`` switches to the approximate form.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("group statistics need at least one key")
    name = names or (lambda column, fn: feature_name(keys, column, fn))
    rows = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), keys, df)
    plain, order = [], []
    for column, fn in specs:
        if not isinstance(fn, str):
            plain.append(fn[1](F.col(column)).alias(name(column, fn[0])))
        elif fn in SIMPLE:
            plain.append(SIMPLE[fn](column).alias(name(column, fn)))
        elif fn in QUANTILES:
            order.append((column, fn))
        else:
            raise ValueError(f"unknown aggregate {fn}")
    if accuracy:
        for column, fn in order:
            qs = [F.percentile_approx(column, q, accuracy) for q in QUANTILES[fn].values()]
            plain.append((qs[0] - qs[1] if len(qs) == 2 else qs[0]).alias(name(column, fn)))
        order = []
    if not order:
        return rows.groupBy(*keys).agg(*plain)
    probs = {k: v for _, fn in order for k, v in QUANTILES[fn].items()}
    columns = list(dict.fromkeys(c for c, _ in order))
    pairs = F.array(*[F.struct(F.lit(c).alias("__column"), F.col(c).cast("double").alias("__value")) for c in columns])
    long = rows.select(*keys, F.explode(pairs).alias("__p")).select(*keys, "__p.*")
    quantiles = group_quantiles(long, "__value", probs, [*keys, "__column"])
    picks = []
    for column, fn in order:
        qs = [F.max(F.when(F.col("__column") == column, F.col(q))) for q in QUANTILES[fn]]
        picks.append((qs[0] - qs[1] if len(qs) == 2 else qs[0]).alias(name(column, fn)))
    wide = quantiles.groupBy(*keys).agg(*picks)
    if not plain:
        return wide
    return rows.groupBy(*keys).agg(*plain).join(wide, keys, "left")


def _filled(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.select(*keys, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in table.columns if c not in keys])


class GroupStats:
    """Group statistics fitted on one table and joined to others, with ratios ``value / (statistic + 1)``.

    Recipes that group by ``live_key`` are computed on the table they are applied to. Undefined statistics (a skew of
    two rows) are 0; rows whose group was never seen get null.
    """

    def __init__(self, recipes: Sequence[Recipe], live_key: str | None = None, accuracy: int | None = None):
        self.recipes, self.live_key, self.accuracy = list(recipes), live_key, accuracy
        self.state: dict[Recipe, DataFrame] = {}

    def _table(self, df: DataFrame, r: Recipe) -> DataFrame:
        return materialise(_filled(group_agg(df, r.keys, r.specs, accuracy=self.accuracy), r.keys))

    def fit(self, df: DataFrame) -> "GroupStats":
        self.state = {r: self._table(df, r) for r in self.recipes if self.live_key not in r.keys}
        return self

    def transform(self, df: DataFrame, ratios: bool = True, salt_on=None) -> DataFrame:
        out, neutral = df, []
        for r in self.recipes:
            table = self.state[r] if r in self.state else self._table(df, r)
            out = lookup_join(out, table, r.keys, salt_on=salt_on, ready=True)
            for column, fn in r.specs:
                if _fn_name(fn) != "count":
                    feature = feature_name(r.keys, column, _fn_name(fn))
                    neutral.append(F.try_divide(F.col(column), F.col(feature) + 1).alias(f"{feature}_neutral"))
        return out.select("*", *neutral) if ratios else out

    def save(self, path: str) -> None:
        for i, r in enumerate(self.recipes):
            if r in self.state:
                self.state[r].write.mode("overwrite").parquet(f"{path}/recipe_{i}")

    def load(self, spark, path: str) -> "GroupStats":
        self.state = {
            r: spark.read.parquet(f"{path}/recipe_{i}") for i, r in enumerate(self.recipes) if self.live_key not in r.keys
        }
        return self


class GroupStatsMerge:
    """Statistics of a side table per id, joined to a main table that must be unique on its id."""

    def __init__(self, side_key: str, specs: Sequence[tuple]):
        self.recipe = recipe([side_key], specs)
        self.state: DataFrame | None = None

    def fit(self, side: DataFrame) -> "GroupStatsMerge":
        self.state = group_agg(side, self.recipe.keys, self.recipe.specs)
        return self

    def transform(self, main: DataFrame, main_key: str) -> DataFrame:
        from .relational import join_validated

        return join_validated(main, self.state, main_key, self.recipe.keys[0], "1:1")


def vs_group_mean(df: DataFrame, keys: Sequence[str], column: str, name: str = "vs_group", salt_on=None) -> DataFrame:
    """Value over the mean of its group, minus 1."""
    joined = attach_groups(df, keys, salt_on=salt_on, __mean=F.avg(column))
    return joined.withColumn(name, F.try_divide(F.col(column), F.col("__mean")) - 1).drop("__mean")


def pct_of_group(df: DataFrame, keys: Sequence[str], column: str, name: str = "pct", salt_on=None) -> DataFrame:
    """Value as a percentage of the group total."""
    joined = attach_groups(df, keys, salt_on=salt_on, __sum=F.sum(column))
    return joined.withColumn(name, F.try_divide(F.col(column), F.col("__sum")) * 100).drop("__sum")


def spread_scale(df: DataFrame, keys: Sequence[str], column: str, name: str = "scaled", salt_on=None) -> DataFrame:
    """Value over the spread (max - min) of its group."""
    joined = attach_groups(df, keys, salt_on=salt_on, __hi=F.max(column), __lo=F.min(column))
    return joined.withColumn(name, F.try_divide(F.col(column), F.col("__hi") - F.col("__lo"))).drop("__hi", "__lo")
