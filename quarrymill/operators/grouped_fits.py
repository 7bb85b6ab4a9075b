"""One model per category value, for any number of categories of any size, in a number of jobs that does not depend on them.

Linear models need the sums of products of a category only; those are one aggregate. Trees grow level by level for all categories
at once: counts per (category, tree, node, column, value), their running sums, the best cut of every node, and the
cuts joined back to the rows. A large category is spread like any other by the partial sums and the range partition of the
running sums; no category is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import key_uniform
from ..plans.ordering import running_sums
from ..plans.session import materialise
from ..plans.skew import lookup_join
from .grams import centred, solve_bayesian, solve_lasso, solve_ridge

LINEAR = ("linear", "ridge", "lasso", "bayesian_ridge")
TREES = ("decision_tree", "random_forest", "boosted_trees")
_NODE = ["category", "tree", "node"]


def linear_by_category(df: DataFrame, category: str, y: str, cols: Sequence[str], ridge: float = 0.0, kind: str = "ridge") -> DataFrame:
    """(category, n, intercept, weights) of every category. ``kind`` ridge (0: least squares, the shortest solution where the
    system is singular), lasso (``ridge`` is its penalty on columns of unit spread) or bayesian_ridge (no parameter). Rows with
    a null in ``y`` or ``cols`` are passed over; so is a null category."""
    cols = list(cols)
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in cols], F.col(y).cast("double")]
    size = len(x)
    complete = df.dropna(subset=[category, y, *cols])
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    sums = complete.groupBy(F.col(category).alias("category")).agg(*[F.sum(x[i] * x[j]).alias(f"s_{i}_{j}") for i, j in cells])
    name = df.schema[category].dataType.simpleString()

    def weights(g):
        n, mean, centre, xx, xy, yy = centred(g)
        if kind == "lasso":
            w = solve_lasso(xx, xy, n, ridge)
        elif kind == "bayesian_ridge":
            w = solve_bayesian(xx, xy, n, yy)[0]
        else:
            w = solve_ridge(xx, xy, n, ridge)
        return centre - mean @ w, w

    def solve(parts):
        for part in parts:
            grams = np.zeros((len(part), size, size))
            for i, j in cells:
                grams[:, i, j] = grams[:, j, i] = part[f"s_{i}_{j}"].to_numpy("f8")
            found = [weights(g) for g in grams]
            yield pd.DataFrame({"category": part["category"], "n": grams[:, 0, 0].astype("i8"), "intercept": [b for b, _ in found], "weights": [w for _, w in found]})

    return sums.mapInPandas(solve, f"category {name}, n long, intercept double, weights array<double>")


def predict_linear_by_category(models: DataFrame, df: DataFrame, category: str, cols: Sequence[str], name: str = "prediction") -> DataFrame:
    """Predictions from the table of ``linear_by_category``; null where the category is null or has no model."""
    table = models.select(F.col("category").alias(category), F.col("intercept").alias("__b"), F.col("weights").alias("__w"))
    rows = lookup_join(df, table, [category], salt_on=df.columns)
    total = F.col("__b")
    for i, c in enumerate(cols):
        total = total + F.col("__w")[i] * F.col(c).cast("double")
    return rows.withColumn(name, total).select(*df.columns, name)


def _best_cuts(rows: DataFrame, columns: int, least: int) -> tuple[DataFrame, DataFrame]:
    """((category, tree, node, n, value), (category, tree, node, feature, cut)) of the open nodes of (category, tree, node, w, t, x)
    rows: mean target, and the cut that lowers the sum of squares most, halfway between two values; ties go to the earlier
    column and the lower cut. Both sides hold ``least`` rows by weight at least."""
    nodes = rows.groupBy(*_NODE).agg(F.sum("w").alias("n"), (F.sum(F.col("w") * F.col("t")) / F.sum("w")).alias("value"))
    long = rows.select(*_NODE, "w", F.col("t"), F.posexplode("x").alias("feature", "v"))
    sums = long.groupBy(*_NODE, "feature", "v").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("t")).alias("s"))
    run = materialise(running_sums(sums, ["v"], ["w", "s"], [*_NODE, "feature"]))
    w, s = F.col("cum_w"), F.col("cum_s")
    rest_w, rest_s = F.col("tot_w") - w, F.col("tot_s") - s
    gain = s * s / w + F.try_divide(rest_s * rest_s, rest_w) - F.col("tot_s") * F.col("tot_s") / F.col("tot_w")
    fair = run.filter((w >= least) & (rest_w >= least)).withColumn("gain", gain).filter(F.col("gain") > 1e-9 * F.abs(F.col("tot_w")))
    # equal gains differ by rounding only: compare them at nine digits
    size = F.bround(F.col("gain") / F.pow(F.lit(10.0), F.floor(F.log10("gain"))), 9)
    order = F.struct(F.floor(F.log10("gain")).alias("e"), size.alias("m"), (-F.col("feature")).alias("f"), (-F.col("v")).alias("v"))
    best = materialise(fair.groupBy(*_NODE).agg(F.max(order).alias("b")).select(*_NODE, (-F.col("b.f")).alias("feature"), (-F.col("b.v")).alias("low")))
    after = run.join(best, [*_NODE, "feature"]).filter("v > low").groupBy(*_NODE).agg(F.min("v").alias("high"))
    cuts = best.join(after, _NODE).select(*_NODE, "feature", ((F.col("low") + F.col("high")) / 2).alias("cut"))
    return nodes, cuts


def _grow(rows: DataFrame, columns: int, depth: int, least: int) -> DataFrame:
    """(category, tree, node, n, value, feature, cut) of the trees of (rid, category, tree, w, t, x) rows; children of node i are
    2 i + 1 (value <= cut) and 2 i + 2, leaves have no feature."""
    rows = rows.withColumn("node", F.lit(0))
    kept = []
    for level in range(depth + 1):
        if level == depth:
            nodes = rows.groupBy(*_NODE).agg(F.sum("w").alias("n"), (F.sum(F.col("w") * F.col("t")) / F.sum("w")).alias("value"))
            kept.append(materialise(nodes.withColumn("feature", F.lit(None).cast("int")).withColumn("cut", F.lit(None).cast("double"))))
            break
        nodes, cuts = _best_cuts(rows, columns, least)
        cuts = materialise(cuts)
        kept.append(materialise(nodes.join(cuts, _NODE, "left").select(*_NODE, "n", "value", "feature", "cut")))
        moved = lookup_join(rows, cuts, _NODE, "inner", ["rid"], ready=True)
        side = F.when(F.get("x", F.col("feature")) <= F.col("cut"), 1).otherwise(2)
        rows = materialise(moved.withColumn("node", F.col("node") * 2 + side).drop("feature", "cut"))
        if rows.isEmpty():
            break
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def _packed(nodes: DataFrame) -> DataFrame:
    """(category, trees): by tree, a map from node to (feature, cut, value)."""
    entry = F.struct("node", F.struct("feature", "cut", "value"))
    trees = nodes.groupBy("category", "tree").agg(F.map_from_entries(F.collect_list(entry)).alias("nodes"))
    return trees.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))


def _walk(nodes: Column, x: Column, depth: int) -> Column:
    def step(at, _):
        node = F.element_at(nodes, at)
        go = F.when(F.get(x, node["feature"]) <= node["cut"], at * 2 + 1).otherwise(at * 2 + 2)
        return F.when(node["feature"].isNull(), at).otherwise(go)

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)
    return F.element_at(nodes, leaf)["value"]


class CategoryModel:
    """Fitted models of all categories: a table, and how to read it."""

    def __init__(self, kind: str, table: DataFrame, cols: Sequence[str], depth: int = 0, rate: float | None = None):
        self.kind, self.table, self.cols, self.depth, self.rate = kind, table, list(cols), depth, rate

    def transform(self, df: DataFrame, category: str, name: str = "prediction") -> DataFrame:
        """Predictions by each row's own model; null where the category is null or has no model, or a column is null."""
        if self.kind == "linear":
            return predict_linear_by_category(self.table, df, category, self.cols, name)
        table = self.table.withColumnsRenamed({"category": category, "trees": "__trees"})
        rows = lookup_join(df, table, [category], salt_on=df.columns)
        x = F.array(*[F.col(c).cast("double") for c in self.cols])
        each = F.transform(F.map_values("__trees"), lambda t: _walk(t, F.col("__x"), self.depth))
        total = F.aggregate(each, F.lit(0.0), lambda a, v: a + v)
        if self.rate is None:
            value = total / F.size("__trees")
        else:  # the first tree is the mean alone, the others are scaled
            value = total * self.rate + _walk(F.element_at("__trees", F.lit(0)), F.col("__x"), self.depth) * (1 - self.rate)
        whole = F.forall("__x", lambda v: v.isNotNull())
        out = rows.withColumn("__x", x).withColumn(name, F.when(whole & F.col("__trees").isNotNull(), value))
        return out.select(*df.columns, name)


def fit_by_category(name: str, df: DataFrame, category: str, y: str, cols: Sequence[str], params: Mapping | None = None) -> CategoryModel:
    """A model of ``y`` for every value of ``category``. Linear kinds take ``regParam``; trees take ``maxDepth``, ``minInstancesPerNode``,
    and ``numTrees`` with ``seed`` (forest: each row enters a tree a Poisson number of times, drawn from its values) or
    ``maxIter`` and ``stepSize`` (boosting: each round fits the residuals of the one before). Rows with a null take no part."""
    params = dict(params or {})
    if name in LINEAR:
        kind = {"linear": "ridge"}.get(name, name)
        reg = 0.0 if name == "linear" else float(params.get("regParam", 0.1))
        return CategoryModel("linear", materialise(linear_by_category(df, category, y, cols, reg, kind)), cols)
    if name not in TREES:
        raise ValueError(f"no grouped form of {name}: use one of {LINEAR + TREES}")
    depth, least = int(params.get("maxDepth", 5)), int(params.get("minInstancesPerNode", 1))
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.dropna(subset=[category, y, *cols]).select(
        F.monotonically_increasing_id().alias("rid"), F.col(category).alias("category"), F.col(y).cast("double").alias("t"), x.alias("x")
    )
    rows = materialise(rows.withColumn("w", F.lit(1.0)).withColumn("tree", F.lit(0)))
    if name == "decision_tree":
        return CategoryModel("trees", materialise(_packed(_grow(rows, len(cols), depth, least))), cols, depth)
    if name == "random_forest":
        trees, seed = int(params.get("numTrees", 20)), int(params.get("seed", 0))
        many = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        u = key_uniform(F.concat_ws(":", F.col("tree"), F.col("t"), F.array_join(F.col("x").cast("array<string>"), ","), F.col("rid")), f"bag{seed}")
        reach, part = F.lit(0.0), np.exp(-1.0)
        upto = part
        for k in range(1, 9):
            reach = reach + F.when(u > upto, 1.0).otherwise(0.0)
            part /= k
            upto += part
        bags = materialise(many.withColumn("w", reach).filter("w > 0"))
        return CategoryModel("trees", materialise(_packed(_grow(bags, len(cols), depth, least))), cols, depth)
    rate = float(params.get("stepSize", 0.1))
    grown = [_grow(rows, len(cols), 0, least)]
    model = CategoryModel("trees", materialise(_packed(grown[0])), cols, depth, rate)
    for turn in range(int(params.get("maxIter", 20))):
        # what the last tree explains leaves the target; the first one is the mean
        last = materialise(_packed(grown[-1])).withColumnRenamed("trees", "__trees")
        scored = lookup_join(rows, last, ["category"], "inner", ["rid"], ready=True)
        taken = _walk(F.element_at("__trees", F.lit(turn)), F.col("x"), depth) * (rate if turn else 1.0)
        rows = materialise(scored.withColumn("t", F.col("t") - taken).withColumn("tree", F.lit(turn + 1)).drop("__trees"))
        grown.append(_grow(rows, len(cols), depth, least))
    every = grown[0]
    for more in grown[1:]:
        every = every.unionByName(more)
    model.table = materialise(_packed(every))
    return model
