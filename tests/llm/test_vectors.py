"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import ann_search, cap_filters

from . import helpers

SCHEMA = "vec_id long, embedding array<double>"
ODD = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0], []]


def table(spark, x, odd=True):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(10_000 + 20 * k, v) for k, v in enumerate(ODD)] if odd else []
    return spark.createDataFrame(rows, SCHEMA).withColumns({"label": F.lit(1), "key": F.lit("x"), "v": F.lit(0), "norm": F.lit(2)})


def vectors(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    x[100:400] = x[100]  # many copies
    for i in range(400, 700):  # groups of near copies
        x[i] = x[i // 20] + 0.06 * rng.normal(size=16)
    return x


@pytest.mark.parametrize("unit", [True, False])
def test_nearest(spark, monkeypatch, unit):
    monkeypatch.setattr(ann_search, "LEAF_ROWS", 200)
    monkeypatch.setattr(ann_search, "BLOCK_ROWS", 60)
    monkeypatch.setattr(ann_search, "BLOCK_QUERIES", 8)
    x = vectors()
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x
    got = ann_search.nearest(table(spark, x), F.col("vec_id") % 20 == 0, k=10).toPandas()
    assert sorted(got["query_id"].unique()) == list(range(0, len(x), 20))
    found = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:10]
        assert list(rows["rank"]) == list(range(1, 11)) and q not in set(rows["vec_id"])
        assert np.allclose(s[rows["vec_id"]], rows["score"], rtol=0, atol=1e-9)
        found += len(set(best) & set(rows["vec_id"]))
    assert found >= 0.95 * 10 * got["query_id"].nunique()


def test_nearest_edges(spark):
    asks = F.col("vec_id") % 2 == 0
    assert ann_search.nearest(spark.createDataFrame([], SCHEMA), asks).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (4, None), (None, [1.0, 1.0])], SCHEMA)
    got = [tuple(r) for r in ann_search.nearest(few, asks).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0)]


def test_chi_square_quantile():
    assert ann_search.chi_square_quantile(0.95, 2) == pytest.approx(-2 * math.log(0.05))
    assert ann_search.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)


def test_boxes_bound_distances():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(500, 4)), rng.normal(size=(20, 4))
    tree = ann_search.KdTree(x, 4)
    reach, leaf = tree.reach(q), tree.leaf(x)
    far = ((q[:, None] - x[None]) ** 2).sum(2)
    assert (reach[:, leaf] <= far + 1e-12).all()
    assert (reach[np.arange(20), tree.leaf(q)] == 0).all()


@pytest.mark.parametrize("block", [1024, 70])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    x = vectors(seed=3)
    got = {r.vec_id: r for r in cap_filters.near_vectors(table(spark, x)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    true = near.sum(1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= true).all() and found.sum() >= 0.99 * true.sum()
    roots = helpers.groups(len(x), zip(*np.nonzero(near)))
    assert np.mean([got[i].component_id == roots[i] for i in range(len(x))]) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all(got[10_000 + 20 * k].n_links == 0 and got[10_000 + 20 * k].kept for k in range(len(ODD)))


def test_near_vectors_edges(spark):
    assert cap_filters.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    only = cap_filters.near_vectors(spark.createDataFrame([(3, None), (None, [1.0])], SCHEMA)).collect()
    assert sorted(map(str, (tuple(r) for r in only))) == sorted(map(str, [(3, 0, 3, True), (None, 0, None, False)]))
    same = spark.createDataFrame([(5, [1.0, 2.0]), (5, [1.0, 2.0]), (7, [2.0, 4.0]), (8, [-1.0, -2.0])], SCHEMA)
    got = sorted(tuple(r) for r in cap_filters.near_vectors(same).collect())
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True)]


def test_decoding_finds_all_directions():
    code = cap_filters.ProductCode(12, 300, 0.9)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scores = code.scores(x)
    for i in range(20):
        own = [s[i] for s in scores]
        every = np.arange(code.each**code.parts)
        assert set(code.decode(own)) == set(every[code._total(own, every) >= code.threshold])
