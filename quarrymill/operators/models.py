"""Model fits by Spark ML: named estimators, searches, folds, stacking and persisted steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
import math
import random

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    FMClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from .blend import oof_table, stack_features
from .boosting import AdaBoost
from .grams import centred, gram, solve_bayesian
from .grouped_fits import CategoryModel, fit_by_category, linear_by_category, predict_linear_by_category  # noqa: F401
from .select import assemble
from .split import add_fold


class LinearFit(Model):
    """Coefficients found by evidence iteration; adds ``prediction`` from a vector column."""

    def __init__(self, coefficients, intercept: float, alpha: float, lam: float, features: str):
        super().__init__()
        self.coefficients, self.intercept, self.alpha, self.lam, self.features = coefficients, intercept, alpha, lam, features

    def _transform(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(v)) for v in self.coefficients])
        parts = F.zip_with(vector_to_array(self.features), w, lambda a, b: a * b)
        return df.withColumn("prediction", F.aggregate(parts, F.lit(self.intercept), lambda a, v: a + v))


class BayesianRidge(Estimator):
    """Ridge whose penalty and noise are found by maximising the evidence, from the cross products of one pass over the rows."""

    def __init__(self, labelCol: str = "label", featuresCol: str = "features", maxIter: int = 300, tol: float = 1e-3):
        super().__init__()
        self.label, self.features, self.rounds, self.tol = labelCol, featuresCol, maxIter, tol

    def _fit(self, df: DataFrame) -> LinearFit:
        x = vector_to_array(self.features)
        width = df.select(F.size(x)).first()[0]
        wide = df.select(*[x[i].alias(f"x{i}") for i in range(width)], F.col(self.label).cast("double").alias("y"))
        g, _ = gram(wide, wide.columns)
        n, mean, centre, xx, xy, yy = centred(g)
        w, alpha, lam = solve_bayesian(xx, xy, n, yy, self.rounds, self.tol)
        return LinearFit(w, float(centre - mean @ w), alpha, lam, self.features)


CLASSIFIERS = {
    "logistic": LogisticRegression,
    "sgd_log": LogisticRegression,
    "linear_svm": LinearSVC,
    "sgd_hinge": LinearSVC,
    "naive_bayes": NaiveBayes,
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "boosted_trees": GBTClassifier,
    "adaboost": AdaBoost,
    "factorization_machine": FMClassifier,
}
#: Fits that hold their rows as trees see them, and rows of a partition for them.
TREES, TREE_ROWS = {"decision_tree", "random_forest", "boosted_trees"}, 1 << 19
BINARY_ONLY = {"linear_svm", "sgd_hinge", "boosted_trees", "factorization_machine"}
REGRESSORS = {
    "linear": (LinearRegression, {}),
    "ridge": (LinearRegression, {"regParam": 0.1, "elasticNetParam": 0.0}),
    "bayesian_ridge": (BayesianRidge, {}),
    "lasso": (LinearRegression, {"regParam": 0.1, "elasticNetParam": 1.0}),
    "decision_tree": (DecisionTreeRegressor, {}),
    "random_forest": (RandomForestRegressor, {}),
    "boosted_trees": (GBTRegressor, {}),
}


def vectorise(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array).cast("array<double>")))


def make_classifier(name: str, y: str, params: Mapping | None = None, classes: int = 2):
    """Estimator by name; two-class methods are wrapped one against the rest for more classes."""
    est = CLASSIFIERS[name](labelCol=y, featuresCol="features", **dict(params or {}))
    if name == "naive_bayes" and "modelType" not in (params or {}):
        est = est.setModelType("gaussian")
    return OneVsRest(classifier=est, labelCol=y, featuresCol="features") if classes > 2 and name in BINARY_ONLY else est


def dealt_for_trees(name: str, df: DataFrame, y: str, params: Mapping | None = None) -> DataFrame:
    """Rows for a fit by trees, whose tasks hold their rows in memory for every pass: a large table is dealt to partitions of at most
    about ``TREE_ROWS``, whatever the files. Other fits take the rows as they are."""
    if name not in TREES:
        return df
    n = df.count()
    if n <= TREE_ROWS:
        return df
    parts = max(-(-n // TREE_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = [v for v in dict(params or {}).values() if isinstance(v, str) and v in df.columns]
    return df.select(*dict.fromkeys(["features", y, *named])).repartition(parts)


def fit_classifier(name: str, df: DataFrame, y: str, params: Mapping | None = None, classes: int = 2):
    return make_classifier(name, y, params, classes).fit(dealt_for_trees(name, df, y, params))


def fit_regressor(name: str, df: DataFrame, y: str, params: Mapping | None = None):
    kind, fixed = REGRESSORS[name]
    return kind(labelCol=y, featuresCol="features", **{**fixed, **dict(params or {})}).fit(dealt_for_trees(name, df, y, params))


def class_probs(model, df: DataFrame, name: str = "probs") -> DataFrame:
    """Class probabilities as an array; margins of methods without probabilities pass through a softmax."""
    from ..functions.arrays import softmax

    out = model.transform(df)
    if "probability" in out.columns:
        return out.withColumn(name, vector_to_array("probability"))
    return out.withColumn(name, softmax(vector_to_array("rawPrediction")))


def sample_params(space: Mapping, n: int, seed: int = 0) -> list[dict]:
    """Random settings: a pair is an integer range; a longer list ends with its mode (list, uniform, log-uniform,
    choice); anything else is fixed."""
    out = []
    for i in range(n):
        rng = random.Random(seed + i)
        out.append({name: _draw(rng, value) if isinstance(value, (list, tuple)) else value for name, value in space.items()})
    return out


# what the last element of a longer list asks for: a draw between or among the values before it
DRAWS = {
    "choice": lambda rng, values: rng.randrange(int(values[0]), int(values[1])),
    "list": lambda rng, values: rng.choice(list(values)),
    "uniform": lambda rng, values: rng.uniform(*values),
    "log-uniform": lambda rng, values: math.exp(rng.uniform(*map(math.log, values))),
}


def _draw(rng: random.Random, value):
    *values, mode = [*value, "choice"] if len(value) == 2 else value
    if mode not in DRAWS:
        raise ValueError(f"unknown mode {mode}")
    return DRAWS[mode](rng, values)


def random_search(
    make: Callable[[dict], object], space: Mapping, n: int, train: DataFrame, valid: DataFrame, evaluator, seed: int = 0, parallelism: int = 2,
):
    """Fit sampled settings, score each on the validation rows by an evaluator and in its direction, return (best model, table of
    settings and scores); the earlier setting wins ties."""
    settings = sample_params(space, n, seed)
    train, valid = train.cache(), valid.cache()

    def run(params: dict):
        return evaluator.evaluate(make(params).fit(train).transform(valid))

    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(run, settings))
    sign = 1 if evaluator.isLargerBetter() else -1
    best = max(range(n), key=lambda i: (sign * scores[i], -i))
    model = make(settings[best]).fit(train)
    rows = [(i, str(sorted(p.items())), float(s), int(i == best)) for i, (p, s) in enumerate(zip(settings, scores))]
    table = train.sparkSession.createDataFrame(rows, "run int, params string, score double, best int")
    train.unpersist()
    valid.unpersist()
    return model, table


def grid_search(est, grid: Sequence, df: DataFrame, evaluator, key: str, y: str, folds: int = 3, parallelism: int = 2):
    """Cross validation over a grid with folds that deal out the classes evenly."""
    from pyspark.ml.tuning import CrossValidator

    rows = add_fold(df, key, folds, y)
    cv = CrossValidator(estimator=est, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism)
    return cv.fit(rows)


def validation_curve(make: Callable, values: Sequence, df: DataFrame, key: str, y: str, score: Callable[[DataFrame], float], folds: int = 3) -> DataFrame:
    """Score per parameter value and fold."""
    rows = add_fold(df, key, folds, y).cache()

    def run(job):
        value, fold = job
        model = make(value).fit(rows.filter(F.col("fold") != fold))
        return str(value), fold, float(score(model.transform(rows.filter(F.col("fold") == fold))))

    with ThreadPoolExecutor(2) as pool:
        out = list(pool.map(run, [(v, f) for v in values for f in range(folds)]))
    rows.unpersist()
    return df.sparkSession.createDataFrame(out, "param string, fold int, score double")


def predict_by_category(model: CategoryModel, df: DataFrame, category: str, name: str = "prediction") -> DataFrame:
    """Predictions by each row's own model; see ``fit_by_category``."""
    return model.transform(df, category, name)


class ColumnStep(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A registered column function as a step that can be saved and loaded with a pipeline."""

    FUNCTIONS: dict[str, Callable] = {
        "log1p": lambda c: F.log1p(F.greatest(c.cast("double"), F.lit(0.0))),
        "fill_zero": lambda c: F.coalesce(c.cast("double"), F.lit(0.0)),
        "identity": lambda c: c,
    }

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, fn: str = "identity"):
        super().__init__()
        from pyspark.ml.param import Param

        self.fn = Param(self, "fn", "registered function")
        self._set(**{k: v for k, v in {"inputCol": inputCol, "outputCol": outputCol, "fn": fn}.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self.FUNCTIONS[self.getOrDefault("fn")](F.col(self.getInputCol())))


def fit_steps(df: DataFrame, steps: Sequence):
    """Fit steps in order; the model holds all state and is saved and loaded as one."""
    return Pipeline(stages=list(steps)).fit(df)


class StackedModel:
    """Two levels: level-1 classifiers per fold give out-of-fold probabilities; a level-2 classifier is fitted on them.
    New rows get the mean level-1 probabilities over folds."""

    def __init__(self, level1: Sequence[tuple[str, str, Mapping]], level2: tuple[str, Mapping], key: str, y: str, classes: int, folds: int = 3):
        self.level1, self.level2 = list(level1), level2
        self.key, self.y, self.classes, self.folds = key, y, classes, folds
        self.models: dict[tuple[str, int], object] = {}
        self.oof: DataFrame | None = None
        self.top = None

    def fit(self, df: DataFrame, parallelism: int = 2) -> "StackedModel":
        rows = add_fold(df.select(self.key, self.y, "features"), self.key, self.folds, self.y).cache()

        def run(job):
            (tag, name, params), fold = job
            return (tag, fold), fit_classifier(name, rows.filter(F.col("fold") != fold), self.y, params, self.classes)

        with ThreadPoolExecutor(parallelism) as pool:
            self.models = dict(pool.map(run, [(m, f) for m in self.level1 for f in range(self.folds)]))
        parts = [
            (fold, tag, class_probs(model, rows.filter(F.col("fold") == fold)).select(self.key, "probs"))
            for (tag, fold), model in self.models.items()
        ]
        self.oof = oof_table(parts, self.key, "probs")
        wide = stack_features(self.oof, self.key, "model", "p").join(df.select(self.key, self.y), self.key)
        self.top = fit_classifier(self.level2[0], _vectors(wide), self.y, self.level2[1], self.classes)
        rows.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        parts = [(fold, tag, class_probs(m, df.select(self.key, "features")).select(self.key, "probs")) for (tag, fold), m in self.models.items()]
        long = oof_table(parts, self.key, "probs").select(self.key, "model", F.posexplode("p").alias("c", "v"))
        mean = long.groupBy(self.key, "model", "c").agg(F.avg("v").alias("v"))
        probs = mean.groupBy(self.key, "model").agg(F.array_sort(F.collect_list(F.struct("c", "v")))["v"].alias("p"))
        wide = stack_features(probs, self.key, "model", "p")
        return class_probs(self.top, _vectors(wide)).select(self.key, "probs", F.col("prediction").cast("int").alias("prediction"))


def _vectors(wide: DataFrame) -> DataFrame:
    return wide.withColumnRenamed("features", "__a").withColumn("features", array_to_vector("__a")).drop("__a")
