"""Feature selection: F values, five-way selector, stepwise regression, lasso, elimination, PCA."""

from __future__ import annotations

from collections.abc import Sequence
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..plans.ordering import running_sums
from ..plans.session import materialise
from .columns import distinct_counts, numeric_cols
from .grams import centred, gram, lars_path
from .profile import correlated_pairs, missing_report, one_hot_correlated_pairs, unique_report


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid="keep").transform(df)


def explode_vector(df: DataFrame, vector: str, dim: int, prefix: str = "x") -> DataFrame:
    """Array entries as numeric columns ``x0 ..``."""
    return df.select("*", *[F.get(vector, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(dim)])


def anova_f(df: DataFrame, y: str, cols: Sequence[str]) -> DataFrame:
    """One-way analysis of variance F per column, from class sums in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs += [F.sum(F.col(c).cast("double")).alias(f"s{i}"), F.sum(F.col(c).cast("double") * F.col(c)).alias(f"q{i}")]
    per_class = df.filter(F.col(y).isNotNull()).groupBy(y).agg(*aggs)
    # one row per class and column from here on
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{i}").alias("s"), F.col(f"q{i}").alias("q")) for i, c in enumerate(cols)])
    long = per_class.select("__n", F.explode(rows).alias("r")).select("__n", "r.*")
    sums = long.groupBy("feature").agg(
        F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("__n")).alias("b")
    )
    mean_part = F.col("s") * F.col("s") / F.col("n")
    between = (F.col("b") - mean_part) / (F.col("k") - 1)
    within = (F.col("q") - F.col("b")) / (F.col("n") - F.col("k"))
    return sums.select("feature", F.try_divide(between, within).alias("f_value"))


def select_k_best(df: DataFrame, y: str, cols: Sequence[str], k: int, score: str = "f") -> list[str]:
    """Names of the k columns with the largest F value, or the largest chi-squared value for non-negative columns."""
    if score == "f":
        table = anova_f(df, y, cols).orderBy(F.col("f_value").desc_nulls_last(), "feature").limit(k)
        return [r["feature"] for r in table.collect()]
    from pyspark.ml.feature import UnivariateFeatureSelector

    selector = UnivariateFeatureSelector(featuresCol="features", labelCol=y, outputCol="kept", selectionMode="numTopFeatures")
    model = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k).fit(assemble(df, cols))
    return [cols[i] for i in model.selectedFeatures]


def select_from_model(df: DataFrame, y: str, cols: Sequence[str], reg: float = 0.01) -> list[str]:
    """Columns whose L1 logistic coefficient, after min-max scaling, is at least the median in size."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import MinMaxScaler

    vectors = assemble(df.filter(F.col(y).isNotNull()), cols, "raw")
    scaled = MinMaxScaler(inputCol="raw", outputCol="features").fit(vectors).transform(vectors)
    model = LogisticRegression(labelCol=y, regParam=reg, elasticNetParam=1.0, maxIter=50).fit(scaled)
    size = np.abs(model.coefficientMatrix.toArray()).sum(axis=0)
    return [c for c, s in zip(cols, size) if s >= np.median(size)]


class FeatureSelector:
    """Missing, single-valued, collinear, zero-importance and low-importance columns: identify, check, remove."""

    METHODS = ("missing", "single_unique", "collinear", "zero_importance", "low_importance")

    def __init__(self, df: DataFrame, y: str | None = None, cols: Sequence[str] | None = None):
        self.df, self.y = df, y
        self.cols = [c for c in (cols or df.columns) if c != y]
        self.ops: dict[str, list[str]] = {}
        self.importances: DataFrame | None = None

    def identify_missing(self, threshold: float) -> "FeatureSelector":
        rows = missing_report(self.df.select(*self.cols), threshold).collect()
        self.ops["missing"] = sorted(r["feature"] for r in rows)
        return self

    def identify_single_unique(self) -> "FeatureSelector":
        rows = unique_report(self.df, self.cols).filter(F.col("single_valued") == 1).collect()
        self.ops["single_unique"] = sorted(r["feature"] for r in rows)
        return self

    def identify_collinear(self, threshold: float, one_hot: bool = False) -> "FeatureSelector":
        """With ``one_hot`` the other columns take part by the 0/1 columns of their values, named ``<column>_<value>``; those are
        reported, and ``remove`` drops the columns that the table has."""
        nums = [c for c in numeric_cols(self.df) if c in self.cols]
        if one_hot:
            pairs = one_hot_correlated_pairs(self.df, nums, [c for c in self.cols if c not in nums], threshold)
        else:
            pairs = correlated_pairs(self.df, nums, threshold)
        self.ops["collinear"] = sorted(r[0] for r in pairs.select("drop_feature").distinct().collect())
        return self

    def identify_zero_importance(self, task: str = "classification", iterations: int = 2, trees: int = 10) -> "FeatureSelector":
        """Mean importance of boosted trees over seeds; normalised and with its running share."""
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.regression import GBTRegressor

        nums = [c for c in numeric_cols(self.df) if c in self.cols]
        vectors = assemble(self.df.filter(F.col(self.y).isNotNull()).na.fill(0, nums), nums).select("features", F.col(self.y).cast("double").alias(self.y)).cache()
        kind = GBTClassifier if task == "classification" else GBTRegressor
        total = np.zeros(len(nums))
        for i in range(iterations):
            model = kind(labelCol=self.y, maxIter=trees, stepSize=0.05, seed=i, subsamplingRate=0.85).fit(vectors)
            total += model.featureImportances.toArray() / iterations
        vectors.unpersist()
        self.importances = importance_table(self.df, nums, total)
        self.ops["zero_importance"] = sorted(c for c, v in zip(nums, total) if v == 0)
        return self

    def identify_low_importance(self, cumulative: float) -> "FeatureSelector":
        if self.importances is None:
            raise ValueError("importances come first")
        rows = self.importances.filter(F.col("cumulative") > cumulative).collect()
        self.ops["low_importance"] = sorted(r["feature"] for r in rows)
        return self

    def identify_all(self, missing: float, collinear: float, cumulative: float, task: str = "classification") -> "FeatureSelector":
        self.identify_missing(missing).identify_single_unique().identify_collinear(collinear)
        return self.identify_zero_importance(task).identify_low_importance(cumulative)

    def check_removal(self, methods: Sequence[str] | str = "all") -> list[str]:
        names = self.METHODS if methods == "all" else methods
        unknown = [m for m in names if m not in self.ops and methods != "all"]
        if unknown:
            raise ValueError(f"not identified yet: {unknown}")
        return sorted({c for m in names for c in self.ops.get(m, [])})

    def remove(self, methods: Sequence[str] | str = "all") -> DataFrame:
        return self.df.drop(*self.check_removal(methods))

    def report(self) -> DataFrame:
        rows = [(m, c) for m, cs in self.ops.items() for c in cs]
        return self.df.sparkSession.createDataFrame(rows, "method string, feature string")


def importance_table(df: DataFrame, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Importance per column, its share and running share, largest first."""
    total = float(np.sum(values)) or 1.0
    rows = [(n, float(v), float(v) / total) for n, v in zip(names, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double, normalized double")
    run = running_sums(table, [F.col("normalized").desc(), F.col("feature")], ["normalized"], totals=False)
    return run.select("feature", "importance", "normalized", F.col("cum_normalized").alias("cumulative"))


def _t_tail(t: float, dof: int) -> float:
    """Two-sided tail of Student's t by the continued fraction of the incomplete beta function."""
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - front * _beta_fraction(b, a, 1 - x) / b
    return front * _beta_fraction(a, b, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + num * d or tiny)
            c = 1.0 + num / c or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return h


def ols_pvalues(gram: np.ndarray, n: int, xs: Sequence[int], y: int) -> np.ndarray:
    """p-values of the slopes of a least-squares fit with intercept, from cross products."""
    at = [0, *xs]
    a, b = gram[np.ix_(at, at)], gram[at, y]
    inverse = np.linalg.pinv(a)
    beta = inverse @ b
    dof = n - len(at)
    rss = max(gram[y, y] - beta @ b, 0.0)
    errors = np.sqrt(np.maximum(np.diag(inverse) * rss / dof, 1e-300))
    return np.array([_t_tail(float(t), dof) for t in (beta / errors)[1:]])


def stepwise(df: DataFrame, y: str, cols: Sequence[str], p_in: float = 0.01, p_out: float = 0.05) -> DataFrame:
    """(feature, place, coefficient, p_value) of forward and backward selection by p-value, in the order of entry. The data is read
    once, every fit uses the same cross products. A column enters while the best one outside is below ``p_in``, and the
    worst one inside leaves above ``p_out``; a set that was there before would come again, so it ends the search."""
    products, n = gram(df, [*cols, y])
    target, chosen, visited = len(cols) + 1, (), set()
    while chosen not in visited:
        visited.add(chosen)
        outside = [i for i in range(1, target) if i not in chosen]
        p, best = min(((ols_pvalues(products, n, [*chosen, i], target)[-1], i) for i in outside), default=(1.0, 0))
        if p < p_in:
            chosen = (*chosen, best)
        if chosen:
            inside = ols_pvalues(products, n, chosen, target)
            if inside.max() > p_out:
                chosen = chosen[: inside.argmax()] + chosen[inside.argmax() + 1 :]
    at = [0, *chosen]
    beta = np.linalg.pinv(products[np.ix_(at, at)]) @ products[at, target]
    inside = ols_pvalues(products, n, chosen, target) if chosen else []
    rows = [(cols[i - 1], k + 1, float(b), float(p)) for k, (i, b, p) in enumerate(zip(chosen, beta[1:], inside))]
    return df.sparkSession.createDataFrame(rows, "feature string, place int, coefficient double, p_value double")


def select_lars(df: DataFrame, y: str, cols: Sequence[str], penalty: float | None = None, most: int | None = None, drop: bool = True) -> DataFrame:
    """(feature, place, coefficient) by the least-angle path: columns in order of entry with their coefficients where the path's
    penalty has fallen to ``penalty``, or where ``most`` columns are in (else at its end). ``drop`` makes it the lasso's path."""
    products, n = gram(df, [*cols, y])
    _, _, _, xx, xy, _ = centred(products)
    path = lars_path(xx, xy, n, drop)
    entered: list[int] = []
    now = path[0][1]
    for (high, before), (low, after) in zip(path, path[1:]):
        if penalty is not None and low < penalty:
            now = before + (after - before) * max(0.0, high - penalty) / (high - low)
        elif most is not None and np.count_nonzero(after) > most:
            break
        else:
            now = after
        entered += [j for j in np.flatnonzero(now) if j not in entered]
        if penalty is not None and low < penalty:
            break
    rows = [(cols[j], k + 1, float(now[j])) for k, j in enumerate(j for j in entered if now[j] != 0)]
    return df.sparkSession.createDataFrame(rows, "feature string, place int, coefficient double")


def select_lasso(df: DataFrame, y: str, cols: Sequence[str], reg: float = 0.1) -> list[str]:
    """Columns with a coefficient other than 0 in an L1-penalised regression."""
    from pyspark.ml.regression import LinearRegression

    rows = assemble(df.filter(F.col(y).isNotNull()), cols)
    model = LinearRegression(labelCol=y, regParam=reg, elasticNetParam=1.0, maxIter=100).fit(rows)
    return [c for c, v in zip(cols, model.coefficients.toArray()) if v != 0]


def _weakest(model, cols: Sequence[str], step: int) -> set[str]:
    """The least important columns of a fitted model, ties by name."""
    weight = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(model.coefficients.toArray())
    return set(sorted(cols, key=lambda c: (weight[list(cols).index(c)], c))[:step])


def elimination_path(df: DataFrame, y: str, cols: Sequence[str], least: int = 1, estimator=None, step: int = 1):
    """[(columns, model)] from all columns down to ``least``: fit, drop the ``step`` least important, fit again."""
    from pyspark.ml.classification import DecisionTreeClassifier

    base = (estimator or DecisionTreeClassifier(maxDepth=5, seed=7)).copy().setLabelCol(y).setFeaturesCol("features")
    kept, path = list(cols), []
    while True:
        model = base.fit(assemble(df, kept))
        path.append((tuple(kept), model))
        if len(kept) <= least:
            return path
        gone = _weakest(model, kept, min(step, len(kept) - least))
        kept = [c for c in kept if c not in gone]


def rfe(df: DataFrame, y: str, cols: Sequence[str], n: int, estimator=None, step: int = 1) -> list[str]:
    """Fit, drop the least important columns, repeat until ``n`` are left."""
    rows = materialise(df.select(*dict.fromkeys([y, *cols])))  # every fit reads them several times
    return list(elimination_path(rows, y, cols, n, estimator, step)[-1][0])


def rfe_grid(df: DataFrame, key: str, y: str, cols: Sequence[str], evaluator, folds: int = 3, least: int = 1, estimator=None, step: int = 1):
    """(columns, table): elimination with the number of columns chosen by cross validation. Every fold walks one path on its
    training rows and scores the model of each size on its held-out rows; the size of best mean score (the smaller one on
    ties) is then reached on all rows. ``table``: n, score, deviation, chosen."""
    from .split import add_fold

    rows = materialise(df.select(*dict.fromkeys([key, y, *cols])))  # dealing out folds and every fit read them several times
    rows = materialise(add_fold(rows, key, folds, y))
    scores: dict[int, list[float]] = {}
    for fold in range(folds):
        test = rows.filter(F.col("fold") == fold)
        for kept, model in elimination_path(rows.filter(F.col("fold") != fold), y, cols, least, estimator, step):
            scores.setdefault(len(kept), []).append(evaluator.evaluate(model.transform(assemble(test, kept))))
    sign = 1 if evaluator.isLargerBetter() else -1
    best = min(scores, key=lambda n: (-sign * np.mean(scores[n]), n))
    table = [(n, float(np.mean(s)), float(np.std(s)), int(n == best)) for n, s in sorted(scores.items())]
    chosen = list(elimination_path(rows, y, cols, best, estimator, step)[-1][0])
    return chosen, df.sparkSession.createDataFrame(table, "n int, score double, deviation double, chosen int")


def pca_block(df: DataFrame, cols: Sequence[str], k: int, prefix: str = "pc") -> DataFrame:
    """Principal components in place of a column group; other columns stay."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    rows = assemble(df, cols, "__block")
    out = PCA(k=k, inputCol="__block", outputCol="__pc").fit(rows).transform(rows)
    arr = vector_to_array("__pc")
    return out.select(*[c for c in df.columns if c not in cols], *[arr[i].alias(f"{prefix}{i}") for i in range(k)])


def cardinality(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    return {r["feature"]: r["n_unique"] for r in distinct_counts(df, cols).collect()}
