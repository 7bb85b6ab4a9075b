"""Adaptive boosting (SAMME): weighted trees, each fitted to the rows that the ones before got wrong."""

from __future__ import annotations

from collections.abc import Sequence
import math

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import softmax
from ..plans.session import materialise


class AdaBoostModel(Model):
    """Trees and their votes. ``prediction`` is the class of most votes (the lower one on ties); ``probability`` is the softmax of the
    votes' shares."""

    def __init__(self, trees: Sequence, votes: Sequence[float], errors: Sequence[float], classes: int, features: str):
        super().__init__()
        self.trees, self.votes, self.errors, self.classes, self.features = list(trees), list(votes), list(errors), classes, features

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        for i, tree in enumerate(self.trees):
            scored = tree.transform(df.withColumnRenamed(self.features, "__x")) if tree.getFeaturesCol() == "__x" else tree.transform(df)
            df = scored.withColumnRenamed("prediction", f"__vote{i}").drop("rawPrediction", "probability").withColumnRenamed("__x", self.features)
        total = sum(self.votes) or 1.0
        # a class's score: its votes, less an even share of the votes against it
        score = [
            sum((F.when(F.col(f"__vote{i}") == k, v).otherwise(-v / (self.classes - 1)) for i, v in enumerate(self.votes)), F.lit(0.0)) / total
            for k in range(self.classes)
        ]
        scored = df.withColumn("__score", F.array(*score))
        top = (F.array_position("__score", F.array_max("__score")) - 1).cast("double")
        shares = softmax(F.transform("__score", lambda s: s / max(1, self.classes - 1)))
        return scored.select(*kept, array_to_vector(shares).alias("probability"), top.alias("prediction"))


class AdaBoost(Estimator):
    """``maxIter`` rounds of trees of ``maxDepth``. The row weights of a round are written, so a lost executor cannot change them. It stops
    early when a tree is right on all weight, or no better than chance."""

    def __init__(self, labelCol="label", featuresCol="features", maxIter: int = 50, stepSize: float = 1.0, maxDepth: int = 1, seed: int = 7):
        super().__init__()
        self.label, self.features, self.rounds, self.rate, self.depth, self.seed = labelCol, featuresCol, maxIter, stepSize, maxDepth, seed

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        rows = df.filter(F.col(self.label).isNotNull()).select(F.col(self.features).alias("__x"), F.col(self.label).cast("double").alias("__y"))
        rows = materialise(rows.withColumn("__w", F.lit(1.0)))
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("__y").alias("k")).first()
        total, classes = float(found["n"]), max(2, int(found["k"] or 0) + 1)
        est = DecisionTreeClassifier(featuresCol="__x", labelCol="__y", weightCol="__w", maxDepth=self.depth, seed=self.seed)
        trees, votes, errors = [], [], []
        for turn in range(self.rounds if total else 0):
            tree = est.fit(rows)
            wrong = (F.col("prediction") != F.col("__y")).cast("double")
            scored = tree.transform(rows).withColumn("__miss", wrong)
            error = (scored.agg(F.sum(F.col("__w") * F.col("__miss"))).first()[0] or 0.0) / total
            if error >= 1 - 1 / classes and trees:
                break
            safe = min(max(error, 1e-12), 1 - 1e-12)
            vote = self.rate * (math.log((1 - safe) / safe) + math.log(classes - 1))
            trees.append(tree)
            votes.append(vote)
            errors.append(error)
            if error <= 1e-12 or error >= 1 - 1 / classes or turn + 1 == self.rounds:
                break
            # the weights keep their sum, the number of rows
            scale = 1 + error * (math.exp(vote) - 1)
            weight = F.col("__w") * F.when(F.col("__miss") == 1, math.exp(vote)).otherwise(1.0) / scale
            rows = materialise(scored.select("__x", "__y", weight.alias("__w")))
        return AdaBoostModel(trees, votes, errors, classes, self.features)
