"""Distribution tests, power transform and association rules."""

from __future__ import annotations

from collections.abc import Sequence
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..plans.ordering import running_sums
from ..plans.scalars import Scalars
from ..plans.session import materialise


def ks_2samp(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Largest distance of the two distribution functions per column, with the asymptotic p-value. All columns share one
    pass over distinct values."""

    def side(df: DataFrame, first: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
        return df.select(F.explode(pairs).alias("p"), F.lit(first).alias("first")).select("p.*", "first").filter(F.col("value").isNotNull())

    counts = side(a, 1).unionByName(side(b, 0)).groupBy("feature", "value").agg(F.sum("first").alias("na"), F.sum(1 - F.col("first")).alias("nb"))
    run = running_sums(counts, ["value"], ["na", "nb"], ["feature"])
    gap = F.abs(F.try_divide("cum_na", "tot_na") - F.try_divide("cum_nb", "tot_nb"))
    found = run.groupBy("feature").agg(F.max(gap).alias("statistic"), F.max("tot_na").alias("na"), F.max("tot_nb").alias("nb"))
    size = F.sqrt(F.try_divide(F.col("na").cast("double") * F.col("nb"), F.col("na") + F.col("nb")))
    x = size * F.col("statistic")
    terms = F.lit(0.0)
    for j in range(1, 31):
        terms = terms + F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * x * x)
    return found.select("feature", "statistic", F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), terms))).alias("pvalue"))


def ks_normal(df: DataFrame, column: str, mean: float = 0.0, std: float = 1.0) -> DataFrame:
    """One-sample statistic against a normal distribution."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    rows = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    return KolmogorovSmirnovTest.test(rows, "x", "norm", mean, std).select(
        F.col("statistic"), F.col("pValue").alias("pvalue")
    )


def boxcox_lambda(df: DataFrame, column: str, grid: Sequence[float] | None = None, tolerance: float = 1e-6) -> float:
    """Power with the best profile likelihood. A bracket is moved and widened while its end wins, then narrowed around the
    best point until it is below the tolerance; each step is one aggregate. Values are taken relative to their geometric
    mean, which changes the likelihood by a constant and keeps powers in range."""
    x = F.col(column).cast("double")
    rows = df.filter(x > 0)
    centre = rows.agg(F.avg(F.ln(x))).first()[0]
    if centre is None:
        return math.nan
    u = F.ln(x) - centre

    def likelihoods(lambdas: Sequence[float]) -> list[float]:
        aggs = []
        for i, lam in enumerate(lambdas):
            z = u if abs(lam) < 1e-12 else F.expm1(u * F.lit(lam)) / lam
            aggs.append((-F.count(x) / 2 * F.ln(F.var_pop(z))).alias(f"l{i}"))
        row = rows.agg(*aggs).first()
        values = [row[f"l{i}"] for i in range(len(lambdas))]
        return [-math.inf if v is None or math.isnan(v) else v for v in values]

    if grid is not None:
        return list(grid)[int(np.argmax(likelihoods(list(grid))))]
    low, high, points = -2.0, 2.0, 17
    for _ in range(200):
        lambdas = list(np.linspace(low, high, points))
        at = int(np.argmax(likelihoods(lambdas)))
        step = (high - low) / (points - 1)
        if at == 0 and low > -1e6:
            low, high = low - 2 * (high - low), lambdas[1]
        elif at == points - 1 and high < 1e6:
            low, high = lambdas[-2], high + 2 * (high - low)
        elif step < tolerance:
            break
        else:
            low, high = lambdas[at] - step, lambdas[at] + step
    return float(lambdas[at])


def boxcox(df: DataFrame, column: str, lam: float | None = None, name: str | None = None) -> DataFrame:
    lam = boxcox_lambda(df, column) if lam is None else lam
    x = F.col(column).cast("double")
    z = F.when(x > 0, F.ln(x)) if abs(lam) < 1e-12 else F.when(x > 0, (F.pow(x, F.lit(lam)) - 1) / lam)
    return df.withColumn(name or f"{column}_boxcox", z)


def pair_rules(df: DataFrame, items: str, support: float = 0.2, confidence: float = 0.8, lift: float = 2.0) -> DataFrame:
    """Rules between single items. Items below the support are dropped before pairs are formed inside a row, so a row
    holds at most ``1 / support`` times its share of them."""
    rows = df.select(F.array_distinct(items).alias("__i"))
    n = Scalars(rows, n=F.count(F.lit(1)).cast("double"))["n"]
    singles = rows.select(F.explode("__i").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    frequent = materialise(singles.filter(F.col("c") / n >= support))
    names = [r["item"] for r in frequent.collect()]
    kept = rows.select(F.array_sort(F.array_intersect("__i", F.array(*[F.lit(x) for x in names]).cast("array<string>"))).alias("__i"))
    places = kept.select("__i", F.posexplode("__i").alias("p", "a"))
    pairs = places.select("a", F.explode(F.slice("__i", F.col("p") + 2, F.greatest(F.size("__i") - F.col("p") - 1, F.lit(0)))).alias("b"))
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") / n >= support)
    both = counts.select("a", "b", "c").unionByName(counts.select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    left = F.broadcast(frequent.select(F.col("item").alias("a"), F.col("c").alias("ca")))
    right = F.broadcast(frequent.select(F.col("item").alias("b"), F.col("c").alias("cb")))
    joined = both.join(left, "a").join(right, "b")
    out = joined.select(
        F.col("a").alias("antecedent"),
        F.col("b").alias("consequent"),
        (F.col("c") / n).alias("support"),
        (F.col("c") / F.col("ca")).alias("confidence"),
        (F.col("c") * n / (F.col("ca") * F.col("cb"))).alias("lift"),
    )
    return out.filter((F.col("confidence") >= confidence) & (F.col("lift") >= lift))


def association_rules(df: DataFrame, items: str, support: float = 0.2, confidence: float = 0.8, lift: float = 2.0) -> DataFrame:
    """Rules of any antecedent size by parallel FP-growth."""
    from pyspark.ml.fpm import FPGrowth

    model = FPGrowth(itemsCol=items, minSupport=support, minConfidence=confidence).fit(df.select(items))
    return model.associationRules.filter(F.col("lift") >= lift)
