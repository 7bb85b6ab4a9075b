"""Adaptive boosting against hand computation; collinear one-hot columns against the dense table."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
import pytest

from quarrymill.operators import boosting, models, profile, select


def stump(x, y, w, classes):
    best = None
    for cut in (np.unique(x)[:-1] + np.unique(x)[1:]) / 2:
        sides = [np.bincount(y[s], w[s], classes) for s in (x <= cut, x > cut)]
        impurity = sum(s.sum() - (s**2).sum() / s.sum() for s in sides)
        if best is None or impurity < best[0] - 1e-12:
            best = (impurity, cut, [int(s.argmax()) for s in sides])
    return np.where(x <= best[1], *best[2])


@pytest.mark.parametrize("classes", [2, 3])
def test_two_rounds_by_hand(spark, classes):
    rng = np.random.default_rng(classes)
    x = np.arange(30.0)
    y = np.minimum((x // (30 / classes)).astype(int), classes - 1)
    y = np.where(rng.random(30) < 0.15, (y + 1) % classes, y)
    df = select.assemble(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double"), ["x"])
    model = models.make_classifier("adaboost", "y", {"maxIter": 2}, classes).fit(df)
    w, score, votes, errors = np.ones(30), np.zeros((30, classes)), [], []
    for _ in range(2):
        found = stump(x, y, w, classes)
        error = w[found != y].sum() / w.sum()
        vote = np.log((1 - error) / error) + np.log(classes - 1)
        w = w * np.where(found != y, np.exp(vote), 1)
        w *= 30 / w.sum()
        votes.append(vote)
        errors.append(error)
        score += vote * (np.eye(classes)[found] - (1 - np.eye(classes)[found]) / (classes - 1))
    assert model.errors == pytest.approx(errors) and model.votes == pytest.approx(votes)
    rows = model.transform(df).orderBy("x").collect()
    assert [r["prediction"] for r in rows] == score.argmax(axis=1).tolist()
    share = np.exp(score / sum(votes) / (classes - 1))
    assert np.array([r["probability"].toArray() for r in rows]) == pytest.approx(share / share.sum(axis=1, keepdims=True))


def test_perfect_and_empty_fits(spark):
    df = select.assemble(spark.createDataFrame([(float(i), float(i > 4)) for i in range(10)], "x double, y double"), ["x"])
    model = boosting.AdaBoost("y").fit(df)
    assert len(model.trees) == 1 and model.errors == [0.0]
    assert model.transform(df).filter(F.col("prediction") != F.col("y")).count() == 0
    assert boosting.AdaBoost("y").fit(df.limit(0)).trees == []


@pytest.mark.parametrize("threshold", [0.12, 0.6])
def test_collinear_one_hot_equals_the_dense_table(spark, big, threshold):
    rng = np.random.default_rng(6)
    n = 150
    frame = pd.DataFrame({"x": rng.normal(size=n), "a": rng.choice(["p", "q", "r"], n, p=[0.7, 0.2, 0.1]), "b": rng.choice(["s", "t"], n), "one": "same"})
    frame["y"] = frame["x"] * 2 + (frame["a"] == "p") * 3 + rng.normal(size=n) * 0.1
    frame["k"] = np.where(frame["a"] == "p", "yes", "no")
    frame.loc[::11, "a"], frame.loc[::13, "x"] = None, np.nan
    cols, cats = ["x", "y"], ["a", "b", "k", "one"]
    dense = pd.get_dummies(frame[cols + cats], columns=cats, dtype=float)
    corr, want = dense.corr(), {}
    for j, b in enumerate(corr.columns):
        for a in corr.columns[:j]:
            if abs(corr.loc[a, b]) > threshold:
                want[(b, a)] = corr.loc[a, b]
    rows = [tuple(None if v is None or v != v else v for v in r) for r in frame[cols + cats].itertuples(index=False)]
    df = spark.createDataFrame(rows, "x double, y double, a string, b string, k string, one string")
    got = {(r[0], r[1]): r[2] for r in profile.one_hot_correlated_pairs(df, cols, cats, threshold).collect()}
    assert got == pytest.approx(want)
    found = select.FeatureSelector(df).identify_collinear(threshold, one_hot=True).ops["collinear"]
    assert found == sorted({b for b, _ in want})
