"""Cases of the third round's later findings: consensus scores, ranks by rows, bounded batches, boosted trees by partitions."""

from collections import Counter
import math
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.operators import textscore as X


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _consensus(rows):
    """Brute force: n-grams of rows with the same id are counted together."""
    hyp, refs = {}, {}
    for i, h, rs in rows:
        for k in range(1, 5):
            grams = lambda t: Counter(tuple(w) for w in zip(*[(t or "").split()[j:] for j in range(k)]))
            hyp.setdefault((i, k), Counter()).update(grams(h))
            for r, t in enumerate(rs):
                refs.setdefault((i, r, k), Counter()).update(grams(t))
    df = Counter(x for x in {(i, g) for (i, _, _), c in refs.items() for g in c})
    df = Counter(g for _, g in df)
    weigh = lambda c: {g: x * (math.log(len(rows)) - math.log(max(1, df[g]))) for g, x in c.items()}
    out = []
    for i, _, rs in rows:
        total = 0.0
        for r in range(len({r for j, r, _ in refs if j == i}) if i is not None else 0):
            value = 0.0
            for k in range(1, 5):
                a, b = weigh(hyp[i, k]), weigh(refs[i, r, k])
                dot = sum(min(a[g], b[g]) * b[g] for g in a if g in b)
                size = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
                value += dot / size if size else dot
            gap = sum(hyp[i, 2].values()) - sum(refs[i, r, 2].values())
            total += value * math.exp(-gap * gap / 72)
        out.append((i, round(total / 4 / len(rs) * 10, 9)))
    return out


@pytest.mark.parametrize("way", ["small", "large"])
def test_consensus_inside_rows_and_by_repeated_ids(spark, request, way):
    if way == "large":
        request.getfixturevalue("big")
    rng = random.Random(8)
    text = lambda: " ".join(rng.choices("abcdefgh", k=rng.randint(0, 9)))
    rows = [(i, text(), [text() for _ in range(rng.randint(1, 3))]) for i in [*range(30), 4, 4, 9, None]]
    rows += [(50, None, ["a b c"]), (51, "a b c", [None, "a b"]), (52, "", ["x"]), (53, "zz zz", ["zz zz zz"])]
    df = spark.createDataFrame(rows, "id long, hyp string, refs array<string>")
    got = [(x.id, round(x.cider, 9)) for x in X.cider(df).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    for a, b in zip(sorted(got, key=key), sorted(_consensus(rows), key=key), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-8)


def test_consensus_of_single_ids_shuffles_no_texts_of_ngrams(spark):
    df = spark.createDataFrame([(i, "a b c", ["a b", "b c d"]) for i in range(9)], "id long, hyp string, refs array<string>")
    assert "gram" not in _plan(X.cider(df))


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_softmax_and_unit_work_a_value_out_once(spark):
    from quarrymill.functions.arrays import softmax, unit

    rows = [([1.0, 2.0, -3.0],), ([0.0, 0.0],), ([5.0],), (None,), ([1.0, None],)]
    df = spark.createDataFrame(rows, "v array<double>")
    scores = F.reverse(F.col("v"))
    for x in df.select("v", softmax(scores).alias("s"), unit("v").alias("u")).collect():
        if x.v is None:
            assert x.s is None and x.u is None
        elif None in x.v:
            assert x.s == [None, None] and x.u == [1.0, None]
        else:
            e = np.exp(np.array(x.v[::-1]) - max(x.v))
            assert x.s == pytest.approx(list(e / e.sum()))
            assert x.u == pytest.approx(list(np.array(x.v) / (np.linalg.norm(x.v) or 1)))
    assert _optimised(df.select(softmax(scores).alias("s"))).count("reverse(") == 1
    # the length is outside the function of an element
    assert "array(SQRT(" in _optimised(df.select(unit("v").alias("u")))


def test_neighbours_are_the_same_in_small_pieces(spark, monkeypatch):
    import pandas as pd

    from quarrymill.operators import neighbors as N

    assert [len(x) for x in N._cut(iter([pd.DataFrame({"a": range(7)}), pd.DataFrame({"a": []})]), 3)] == [3, 3, 1]
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 3))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    monkeypatch.setattr(N, "SHARD_ROWS", 8)
    monkeypatch.setattr(N, "CELLS", 40)
    got = {}
    for x in N.knn(df, df, "id", "v", 3, exclude_self=True).collect():
        got.setdefault(x.id, {})[x["rank"]] = x.neighbor
    for i in range(60):
        d = np.linalg.norm(v - v[i], axis=1)
        d[i] = np.inf
        assert [got[i][k] for k in (1, 2, 3)] == np.argsort(d)[:3].tolist()


def test_rank_products_are_added_up_in_small_pieces(spark, monkeypatch):
    from quarrymill.operators import profile as P

    rng = random.Random(3)
    rows = [(float(rng.randint(0, 5)), rng.random() if rng.random() < 0.8 else None, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    whole = {(x.a, x.b): x["corr"] for x in P.corr_matrix(df, df.columns, "spearman").collect()}
    monkeypatch.setattr(P, "HELD_RANKS", 5)
    small = {(x.a, x.b): x["corr"] for x in P.corr_matrix(df, df.columns, "spearman").collect()}
    assert whole.keys() == small.keys() and all(abs(whole[x] - small[x]) < 1e-12 for x in whole)


def test_rows_for_trees_are_dealt_to_bounded_partitions(spark, monkeypatch):
    from quarrymill.operators import models as Mo, select as S

    rows = spark.createDataFrame([(float(i % 5), float(i % 3), i) for i in range(300)], "x double, y double, n int").coalesce(1)
    df = S.assemble(rows, ["x"])
    assert Mo.dealt_for_trees("boosted_trees", df, "y") is df
    monkeypatch.setattr(Mo, "TREE_ROWS", 20)
    dealt = Mo.dealt_for_trees("boosted_trees", df, "y", {"weightCol": "n"})
    assert set(dealt.columns) == {"features", "y", "n"} and dealt.count() == 300
    assert max(map(len, dealt.rdd.glom().collect())) <= 20
    assert Mo.dealt_for_trees("linear", df, "y") is df


def test_elimination_reads_its_source_once(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from quarrymill.operators import select as S

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(i):
        seen.add(1)
        return float(i % 7)

    df = spark.range(200).select("id", slow("id").alias("a"), (F.col("id") % 2).cast("double").alias("y"), F.rand(3).alias("b"))
    chosen, table = S.rfe_grid(df, "id", "y", ["a", "b"], BinaryClassificationEvaluator(labelCol="y"), 2)
    assert seen.value == 200 and len(chosen) == table.filter("chosen = 1").first()["n"]


@pytest.mark.parametrize("spread", [-2.0, -30.0])
@pytest.mark.parametrize("rows, cells", [(1 << 14, 1 << 20), (7, 50)])
def test_mutual_information_by_products(spark, monkeypatch, spread, rows, cells):
    from quarrymill.operators import metrics as M

    monkeypatch.setattr(M, "MI_ROWS", rows)
    monkeypatch.setattr(M, "MI_CELLS", cells)
    rng = np.random.default_rng(4)
    v, lv = 100 + rng.normal(size=(50, 4)), spread + rng.normal(size=(50, 4)) / 9
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(v, lv))], "id long, mu array<double>, lv array<double>")
    d = -0.5 * ((v[:, None] - v[None]) ** 2 / np.exp(lv)[None]).sum(axis=2) - 0.5 * (4 * math.log(2 * math.pi) + lv.sum(axis=1))[None]
    log_q = np.log(np.exp(d - d.max(axis=1, keepdims=True)).sum(axis=1)) + d.max(axis=1) - math.log(50)
    want = (-0.5 * 4 * math.log(2 * math.pi) - 0.5 * (1 + lv).sum(axis=1)).mean() - log_q.mean()
    assert M.gaussian_mi(df, "id", "mu", "lv", block=2).first()[0] == pytest.approx(want, abs=1e-8)
