"""Evaluation metrics as aggregates over a prediction table."""

from __future__ import annotations

from collections.abc import Sequence
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..plans.ordering import rank_table, row_numbers, running_sums
from ..plans.scalars import Scalars
from ..plans.session import materialise

# Cuts tried by the threshold search
CUTS = (0.1, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9)


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))


def _rates(tp, fp, fn):
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))


def _f1(tp, fp, fn):
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def binary_metrics(df: DataFrame, y: str, p: str, cut: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of ``p > cut`` in one pass."""
    hit, pos = F.col(p) > cut, F.col(y) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _rates(tp, fp, fn)
    return counts.select(
        *by,
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(tp, fp, fn).alias("f1"),
    )


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = confusion(df, y, p)
    sides = F.array(
        F.struct(F.col(y).alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col(p).alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted")),
    )
    hits = F.when(F.col(y) == F.col(p), F.col("n")).otherwise(0)
    long = cells.select(hits.alias("hit"), F.posexplode(sides).alias("side", "s")).select("s.*", F.when(F.col("side") == 0, F.col("hit")).otherwise(0).alias("tp"))
    sums = long.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"))
    tp, fp, fn = F.col("tp"), F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")
    precision, recall = _rates(tp, fp, fn)
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), _f1(tp, fp, fn).alias("f1"), "support")


def macro_f1(df: DataFrame, y: str, p: str) -> DataFrame:
    return class_report(df, y, p).agg(F.avg("f1").alias("macro_f1"))


def score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives, negatives and rows per distinct score: all that the curve metrics need of the rows."""
    rows = df.filter(F.col(p).isNotNull() & F.col(y).isNotNull())
    return rows.groupBy(*by, p).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


def roc_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Points of the curve per distinct score from the highest one."""
    run = running_sums(score_counts(df, y, p, by), [F.col(p).desc()], ["pos", "neg"], by)
    return run.select(
        *by, F.col(p).alias("threshold"), F.try_divide("cum_neg", "tot_neg").alias("fpr"), F.try_divide("cum_pos", "tot_pos").alias("tpr")
    )


def auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve by the trapezoid rule; tied scores count half."""
    run = running_sums(score_counts(df, y, p, by), [F.col(p).desc()], ["pos", "neg"], by)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    return run.groupBy(*by).agg(F.try_divide(area, F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("auc"))


def auc_by_fold(df: DataFrame, y: str, p: str, fold: str = "fold") -> DataFrame:
    """Mean and population deviation of the area over folds."""
    return auc(df, y, p, [fold]).agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))


def auc_grid(df: DataFrame, y: str, p: str, n: int = 1000) -> DataFrame:
    """Area from ``n`` equal thresholds in [0, 1] with right-side rectangles. Scores are counted per threshold first, so
    the window sees at most ``n + 1`` rows."""
    steps = F.lit(float(n - 1))
    guess = F.floor(F.col(p) * steps)
    place = F.when((guess + 1) / steps <= F.col(p), guess + 1).when(guess / steps > F.col(p), guess - 1).otherwise(guess)
    inside = F.greatest(F.least(place, F.lit(n - 1)), F.lit(-1))
    cells = df.groupBy(inside.alias("i")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    grid = df.sparkSession.range(-1, n).select(F.col("id").alias("i"))
    full = grid.join(F.broadcast(cells), "i", "left").na.fill(0)
    above = W.orderBy(F.col("i").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    every = W.partitionBy()
    rates = full.select(
        "i",
        F.try_divide(F.sum("pos").over(above), F.sum("pos").over(every)).alias("pta"),
        F.try_divide(F.sum("neg").over(above), F.sum("neg").over(every)).alias("pfa"),
    ).filter(F.col("i") >= 0)
    before = F.coalesce(F.lag("pfa").over(W.orderBy("i")), F.lit(1.0))
    return rates.select((F.col("pta") * (before - F.col("pfa"))).alias("part")).agg(F.sum("part").alias("auc"))


def max_recall(df: DataFrame, y: str, p: str, precision: float = 0.97) -> DataFrame:
    """Best recall of the negative class among the cuts whose precision for it reaches the level."""
    run = running_sums(score_counts(df, y, p), [F.col(p).asc()], ["pos", "neg"])
    found = F.when(F.col("cum_neg") / (F.col("cum_neg") + F.col("cum_pos")) >= precision, F.try_divide("cum_neg", "tot_neg"))
    return run.agg(F.coalesce(F.max(found), F.lit(0.0)).alias("max_recall"))


class ThresholdSelection:
    """The cut with the best F1 of ``p > cut``, the first one on ties."""

    def __init__(self, cuts: Sequence[float] = CUTS):
        self.cuts = tuple(cuts)
        self.best: float | None = None

    def scores(self, df: DataFrame, y: str, p: str) -> DataFrame:
        aggs = []
        for i, c in enumerate(self.cuts):
            hit = F.col(p) > c
            aggs += [F.count_if(hit & (F.col(y) == 1)).alias(f"tp{i}"), F.count_if(hit).alias(f"hit{i}")]
        one = df.agg(F.count_if(F.col(y) == 1).alias("pos"), *aggs)
        rows = [
            F.struct(F.lit(float(c)).alias("threshold"), F.coalesce(F.try_divide(2.0 * F.col(f"tp{i}"), F.col(f"hit{i}") + F.col("pos")), F.lit(0.0)).alias("f1"))
            for i, c in enumerate(self.cuts)
        ]
        return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    def fit(self, df: DataFrame, y: str, p: str) -> "ThresholdSelection":
        self.best = self.scores(df, y, p).orderBy(F.col("f1").desc(), "threshold").first()["threshold"]
        return self

    def transform(self, df: DataFrame, p: str, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, (F.col(p) > self.best).cast("int"))


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    error = F.col(y).cast("double") - F.col(p)
    mse = F.avg(error * error)
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"))


def logloss(df: DataFrame, y: str, probs: str) -> DataFrame:
    """Mean negative log probability of the true class; infinite when one of them is 0."""
    p = F.element_at(F.col(probs), F.col(y).cast("int") + 1).cast("double")
    return df.agg(F.avg(F.when(p > 0, -F.ln(p)).otherwise(F.lit(float("inf")))).alias("logloss"))


def gini_norm(df: DataFrame, y: str, p: str, key: str) -> DataFrame:
    """Gini of the prediction order (ties by key, then value) over the Gini of the perfect order. The sum of running sums
    equals a sum of values times the rows that follow, so row numbers are needed for the first order only; equal values
    share the mean of their places in the second, so counts per value do."""
    rows = df.select(F.col(key).alias("k"), F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"))
    by_p = row_numbers(rows, [F.col("p").desc(), F.col("k"), F.col("y")], name="i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("i")).alias("w"), F.sum("y").alias("total"))
    by_y = rank_table(rows, "y", descending=True).agg(F.sum(F.col("y") * F.col("n") * F.col("rank_avg")).alias("w"))
    best = Scalars(by_y, w=F.first("w"))["w"]

    def gini(w):
        return ((F.col("n") + 1) - w / F.col("total") - (F.col("n") + 1) / 2) / F.col("n")

    return by_p.select((gini(F.col("w")) / gini(best)).alias("gini"))


def kappa(df: DataFrame, y: str, p: str) -> DataFrame:
    """Agreement beyond chance, from the confusion counts."""
    cells = confusion(df, y, p)
    n = Scalars(cells, n=F.sum("n"), hit=F.coalesce(F.sum(F.when(F.col(y) == F.col(p), F.col("n"))), F.lit(0)))
    shares = cells.select(F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col(y).cast("string").alias("c"), "n"), F.struct(F.lit(1).alias("s"), F.col(p).cast("string").alias("c"), "n"))).alias("x")).select("x.*")
    sides = shares.groupBy("c").agg(F.sum(F.when(F.col("s") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("s") == 1, F.col("n")).otherwise(0)).alias("b"))
    chance = sides.agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("e"))
    expected = F.col("e") / (n["n"] * n["n"])
    return chance.select(F.try_divide(n["hit"] / n["n"] - expected, 1 - expected).alias("kappa"))


def cv_summary(scores: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each fold score."""
    return scores.agg(*[f(c).alias(f"{c}_{s}") for c in cols for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))])


def active_units(df: DataFrame, vector: str, delta: float = 0.01) -> DataFrame:
    """Sample variance per dimension and whether it reaches ``delta``; one vector aggregate, rows are not exploded."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    one = df.select(Summarizer.variance(array_to_vector(F.col(vector).cast("array<double>"))).alias("v"))
    out = one.select(F.posexplode(vector_to_array("v")).alias("dim", "variance"))
    return out.withColumn("active", (F.col("variance") >= delta).cast("int"))


#: Rows of a block of codes, densities that a task holds at once, and the error of a squared distance that products may have.
MI_ROWS, MI_CELLS, MI_ERROR = 1 << 14, 1 << 20, 1e-9


def gaussian_mi(df: DataFrame, key: str, mu: str, logvar: str, z: str | None = None, block: int = 1024) -> DataFrame:
    """Mutual information of Gaussian codes: mean of ``ln q(z|x)`` minus the mean of ``ln`` of the aggregate posterior.

    The aggregate posterior of each sample sums over all codes by definition. Samples and codes are cut into blocks of at least
    ``block`` and at most about ``MI_ROWS`` rows, as many as keep the tasks busy: every row travels once to each block. A task meets
    two blocks and returns one maximum and one sum per sample, never a pair. Squares come from matrix products, or from differences
    where products would not be right to ``MI_ERROR``.
    """
    codes = df.select(
        F.col(key).alias("id"),
        F.col(mu).cast("array<double>").alias("mu"),
        F.col(logvar).cast("array<double>").alias("lv"),
        F.col(z or mu).cast("array<double>").alias("z"),
    )
    codes = materialise(codes)
    n = codes.count()
    busy = 2 * math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    blocks = max(1, min(-(-n // block), max(-(-n // MI_ROWS), busy)))
    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = codes.select("id", "z", place.alias("zb")).withColumn("mb", every)
    right = codes.select("id", "mu", "lv", place.alias("mb")).withColumn("zb", every)

    most, error = MI_CELLS, MI_ERROR

    def densities(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": np.array([], dtype="int64"), "top": [], "total": []})
        mus, lvs = np.stack(b["mu"].to_numpy()), np.stack(b["lv"].to_numpy())
        fixed = -0.5 * (mus.shape[1] * np.log(2 * np.pi) + lvs.sum(axis=1))
        z, sharp = np.stack(a["z"].to_numpy()), np.exp(-lvs)
        centre = mus.mean(axis=0)
        near, far = z - centre, mus - centre
        # the products' terms are at most this large, and rounding is a share of them
        largest = 4 * mus.shape[1] * (max(np.abs(near).max(initial=0), np.abs(far).max(initial=0)) ** 2) * sharp.max(initial=0)
        exact = not largest * np.finfo(float).eps < error
        pull, own = (far * sharp).T, (far * far * sharp).sum(axis=1)
        tops, totals = np.empty(len(z)), np.empty(len(z))
        step = max(1, most // (mus.size if exact else len(mus)))
        for i in range(0, len(z), step):
            x = near[i : i + step]
            if exact:
                d = ((z[i : i + step, None, :] - mus[None, :, :]) ** 2 * sharp[None, :, :]).sum(axis=2)
            else:
                d = np.maximum((x * x) @ sharp.T - 2 * (x @ pull) + own, 0.0)
            d *= -0.5
            d += fixed
            top = d.max(axis=1)
            d -= top[:, None]
            tops[i : i + step], totals[i : i + step] = top, np.exp(d, out=d).sum(axis=1)
        return pd.DataFrame({"id": a["id"].to_numpy(), "top": tops, "total": totals})

    parts = left.groupBy("zb", "mb").cogroup(right.groupBy("zb", "mb")).applyInPandas(densities, "id long, top double, total double")
    parts = materialise(parts)
    tops = parts.groupBy("id").agg(F.max("top").alias("m"))
    log_q = parts.join(tops, "id").groupBy("id", "m").agg(F.sum(F.col("total") * F.exp(F.col("top") - F.col("m"))).alias("s"))
    posterior = log_q.agg(F.avg(F.col("m") + F.ln("s") - F.ln(F.lit(float(n)))).alias("v"))
    size = F.size("lv")
    entropy = F.lit(-0.5) * size * F.ln(F.lit(2.0) * F.pi()) - 0.5 * F.aggregate("lv", F.lit(0.0), lambda s, x: s + 1 + x)
    own = Scalars(codes, v=F.avg(entropy))["v"]
    return posterior.select((own - F.col("v")).alias("mutual_information"))
