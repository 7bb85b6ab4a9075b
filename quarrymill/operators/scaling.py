"""Scalers and residual features whose constants come from one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans.scalars import Scalars
from ..plans.skew import lookup_join
from ..plans.session import materialise


def minmax_sum(df: DataFrame, cols: Sequence[str], name: str = "score") -> DataFrame:
    """Each column scaled to [0, 1] over the whole table, then summed."""
    s = Scalars(df, **{f"lo_{c}": F.min(c) for c in cols}, **{f"hi_{c}": F.max(c) for c in cols})
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(F.try_divide(F.col(c) - s[f"lo_{c}"], s[f"hi_{c}"] - s[f"lo_{c}"]), F.lit(0.0))
    return df.withColumn(name, total)


def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_std") -> DataFrame:
    """Mean 0 and population standard deviation 1; a constant column becomes 0."""
    s = Scalars(df, **{f"m_{c}": F.avg(c) for c in cols}, **{f"s_{c}": F.stddev_pop(c) for c in cols})
    return df.withColumns(
        {c + suffix: F.coalesce(F.try_divide(F.col(c) - s[f"m_{c}"], s[f"s_{c}"]), F.when(F.col(c).isNotNull(), 0.0)) for c in cols}
    )


class MinMax:
    """Min-max scaler fitted on one table (nulls filled) and applied to others."""

    def __init__(self, cols: Sequence[str], fill: float = 0.0):
        self.cols, self.fill = list(cols), fill
        self.state: DataFrame | None = None

    def fit(self, df: DataFrame) -> "MinMax":
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(self.fill)).alias(c) for c in self.cols])
        self.state = materialise(
            filled.agg(*[F.min(c).alias(f"lo_{c}") for c in self.cols], *[F.max(c).alias(f"hi_{c}") for c in self.cols])
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        s = Scalars(self.state, **{c: F.first(c) for c in self.state.columns})
        out = {}
        for c in self.cols:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.fill))
            out[c] = F.coalesce(F.try_divide(x - s[f"lo_{c}"], s[f"hi_{c}"] - s[f"lo_{c}"]), F.lit(0.0))
        return df.withColumns(out)


def residual_feature(df: DataFrame, y: str, x: str, by: Sequence[str] = (), name: str = "residual") -> DataFrame:
    """What a least-squares line on ``x`` leaves of ``y``, over the table or within groups."""
    line = {"__slope": F.regr_slope(y, x), "__icept": F.regr_intercept(y, x)}
    if not by:
        s = Scalars(df, **line)
        return df.withColumn(name, F.col(y) - (s["__slope"] * F.col(x) + s["__icept"]))
    fits = df.groupBy(*by).agg(*[agg.alias(k) for k, agg in line.items()])
    joined = lookup_join(df, fits, by)
    return joined.withColumn(name, F.col(y) - (F.col("__slope") * F.col(x) + F.col("__icept"))).drop(*line)


def residual_by_model(df: DataFrame, y: str, xs: Sequence[str], estimator=None, name: str = "residual") -> DataFrame:
    """Target minus the prediction of a regressor on several columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    vectors = VectorAssembler(inputCols=list(xs), outputCol="__x", handleInvalid="keep").transform(df)
    est = estimator or LinearRegression()
    est = est.copy().setFeaturesCol("__x").setLabelCol(y).setPredictionCol("__p")
    scored = est.fit(vectors).transform(vectors)
    return scored.withColumn(name, F.col(y) - F.col("__p")).select(*df.columns, name)


def mask_predictions(values: DataFrame, flags: DataFrame, key: str, value: str, flag: str) -> DataFrame:
    """Predictions set to 0 where a second model's flag is 0."""
    joined = values.join(flags.select(key, flag), key, "left")
    return joined.withColumn(value, F.when(F.col(flag) == 0, 0.0).otherwise(F.col(value)))
