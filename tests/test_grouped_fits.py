"""Models per category against brute force, category by category."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.operators import grams, models, select


def tree(x, t, depth, least=1):
    """Brute-force regression tree: returns a predictor."""
    best = None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                left = x[:, f] <= low
                if min(left.sum(), (~left).sum()) < least:
                    continue
                gain = round(sum(t[s].sum() ** 2 / s.sum() for s in (left, ~left)) - t.sum() ** 2 / len(t), 7)
                if gain > 1e-7 and (best is None or gain > best[0]):
                    best = (gain, f, (low + high) / 2)
    if best is None:
        return lambda row: t.mean()
    _, f, cut = best
    left = x[:, f] <= cut
    low, high = tree(x[left], t[left], depth - 1, least), tree(x[~left], t[~left], depth - 1, least)
    return lambda row: low(row) if row[f] <= cut else high(row)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    rows = []
    for k in range(40):
        for _ in range(3 + 2 * (k % 9)):
            a, b = float(rng.integers(0, 6)), float(rng.normal())
            rows.append((len(rows), f"k{k}", a, b, float(np.round(3 * (a > 2) * (k % 3) + b + rng.normal(), 4))))
    rows += [(len(rows) + i, "hot", float(i % 7), float(i), float((i % 7) * 2 + (i > 100))) for i in range(300)]
    return rows


SCHEMA = "id long, k string, a double, b double, y double"


@pytest.mark.parametrize("limit", ["small", "salted"])
def test_trees_match_brute_force(spark, data, limit, monkeypatch):
    if limit == "salted":
        from quarrymill.plans import skew

        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    odd = [(9001, None, 1.0, 1.0, 1.0), (9002, "k0", None, 1.0, 1.0), (9003, "alone", 1.0, 2.0, 5.0), (9004, "unseen", 1.0, 2.0, None)]
    df = spark.createDataFrame(data + odd, SCHEMA)
    model = models.fit_by_category("decision_tree", df, "k", "y", ["a", "b"], {"maxDepth": 3, "minInstancesPerNode": 2})
    got = {r["id"]: r["prediction"] for r in models.predict_by_category(model, df, "k").collect()}
    for k in {r[1] for r in data}:
        mine = [r for r in data if r[1] == k]
        x, t = np.array([r[2:4] for r in mine]), np.array([r[4] for r in mine])
        fitted = tree(x, t, 3, 2)
        for r in mine:
            assert got[r[0]] == pytest.approx(fitted(r[2:4]))
    assert got[9003] == 5.0 and got[9001] is got[9002] is got[9004] is None


def test_boosting_adds_trees_of_residuals(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    model = models.fit_by_category("boosted_trees", df, "k", "y", ["a", "b"], {"maxDepth": 1, "maxIter": 2, "stepSize": 0.5})
    got = {r["id"]: r["prediction"] for r in models.predict_by_category(model, df, "k").collect()}
    for k in ("k8", "hot"):
        mine = [r for r in data if r[1] == k]
        x, t = np.array([r[2:4] for r in mine]), np.array([r[4] for r in mine])
        fit = np.full(len(t), t.mean())
        for _ in range(2):
            step = tree(x, t - fit, 1)
            fit = fit + 0.5 * np.array([step(row) for row in x])
        assert [got[r[0]] for r in mine] == pytest.approx(fit.tolist())


def test_forest_lies_within_the_targets(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    model = models.fit_by_category("random_forest", df, "k", "y", ["a", "b"], {"maxDepth": 3, "numTrees": 6})
    rows = models.predict_by_category(model, df, "k").filter("k = 'hot'").collect()
    truth, found = np.array([r["y"] for r in rows]), np.array([r["prediction"] for r in rows])
    assert len(rows) == 300 and found.min() >= truth.min() and found.max() <= truth.max()
    assert np.corrcoef(truth, found)[0, 1] > 0.9


def test_ten_thousand_categories(spark):
    df = spark.range(40_000).selectExpr("id", "id div 4 AS k", "cast(id % 4 AS double) AS x", "cast(id % 4 + id div 4 AS double) AS y")
    linear = models.fit_by_category("linear", df, "k", "y", ["x"])
    off = models.predict_by_category(linear, df, "k").agg(F.max(F.abs(F.col("prediction") - F.col("y"))), F.count("prediction")).first()
    assert off[0] < 1e-6 and off[1] == 40_000
    trees = models.fit_by_category("decision_tree", df, "k", "y", ["x"], {"maxDepth": 2})
    off = models.predict_by_category(trees, df, "k").agg(F.max(F.abs(F.col("prediction") - F.col("y"))), F.count("prediction")).first()
    assert off[0] < 1e-9 and off[1] == 40_000


def frame(n=60, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) * [1, 2, 0.5, 1, 3]
    x[:, 3] += x[:, 0]
    y = 2 * x[:, 0] - x[:, 1] + 0.7 * x[:, 3] + rng.normal(size=n) * 0.5 + 4
    return x, y


def table(spark, x, y):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(t), "one") for r, t in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, k string"), names


def test_lasso_by_category_matches_one_fit(spark):
    x, y = frame()
    df, names = table(spark, x, y)
    one = models.fit_regressor("lasso", select.assemble(df, names), "y", {"regParam": 0.3, "tol": 1e-10, "maxIter": 500})
    many = models.fit_by_category("lasso", df, "k", "y", names, {"regParam": 0.3}).table.first()
    assert many["weights"] == pytest.approx(list(one.coefficients), abs=2e-3)


def bayesian(x, y):
    """Evidence iteration by explicit inverses."""
    mean, centre = x.mean(axis=0), y.mean()
    x, y = x - mean, y - centre
    alpha, lam, w = 1 / y.var(), 1.0, None
    for _ in range(300):
        cover = np.linalg.inv(lam * np.eye(x.shape[1]) + alpha * x.T @ x)
        new = alpha * cover @ x.T @ y
        known = x.shape[1] - lam * np.trace(cover)
        lam, alpha = (known + 2e-6) / (new @ new + 2e-6), (len(y) - known + 2e-6) / (((y - x @ new) ** 2).sum() + 2e-6)
        if w is not None and np.abs(new - w).sum() < 1e-3:
            break
        w = new
    w = alpha * np.linalg.inv(lam * np.eye(x.shape[1]) + alpha * x.T @ x) @ x.T @ y
    return w, centre - mean @ w, alpha, lam


def test_bayesian_ridge(spark):
    x, y = frame()
    df, names = table(spark, x, y)
    w, b, alpha, lam = bayesian(x, y)
    model = models.fit_regressor("bayesian_ridge", select.assemble(df, names), "y")
    assert list(model.coefficients) == pytest.approx(w, rel=1e-6) and model.intercept == pytest.approx(b)
    assert (model.alpha, model.lam) == pytest.approx((alpha, lam), rel=1e-6)
    found = [r["prediction"] for r in model.transform(select.assemble(df, names)).collect()]
    assert found == pytest.approx((x @ w + b).tolist())
    grouped = models.fit_by_category("bayesian_ridge", df, "k", "y", names).table.first()
    assert grouped["weights"] == pytest.approx(w, rel=1e-6)


def test_least_angle_path_is_the_lasso(spark):
    x, y = frame()
    df, names = table(spark, x, y)
    g, n = grams.gram(df, [*names, "y"])
    assert n == 60 and g[1:, 1:] == pytest.approx(np.c_[x, y].T @ np.c_[x, y])
    _, _, _, xx, xy, _ = grams.centred(g)
    path = grams.lars_path(xx, xy, n)
    assert all(a[0] >= b[0] for a, b in zip(path, path[1:]))
    for level, w in path:
        assert w == pytest.approx(grams.solve_lasso(xx, xy, n, level), abs=1e-6)
    assert path[-1][1] == pytest.approx(np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)[0])
