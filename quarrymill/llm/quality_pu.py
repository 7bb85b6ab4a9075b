"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled texts are all that is learned from; negatives are never used. With g(x) the score of a text,
p the class prior and the squared loss, the unbiased risk is

    p E_pos[l(g) - l(-g)] + E_unl[l(-g)],   l(z) = (1 - z)^2 / 4,

its part for negatives, E_unl[l(-g)] - p E_pos[l(-g)], must not fall below zero (the non-negative form); here the ridge, chosen
by cross-validation of the risk, is raised until it does not. Texts are described by shares of characters, words and lines, binned at quantiles of the unlabelled
texts; g is linear in the bins, so its risk depends on the data by second moments only: one pass over all texts gathers them,
whatever their number, and the driver solves a system of some hundred unknowns. The prior is the smallest ratio of
unlabelled to positive mass among high scores, from a histogram over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.session import materialise
from .wordhash import IS_SPACE, buffers, mix, slices, words

FEATURES = [
    "letters", "upper", "digits", "marks", "stops", "word_bytes", "adjacent", "distinct", "shared", "marked_words",
    "line_ends", "line_words", "bars", "size", "pairs",
]
BINS = 12
RIDGES = tuple(10 ** (-k / 2) for k in range(9))
FOLDS = 3
CELLS = 400  # cells of the score histogram for the prior

_KIND = np.zeros(256, "u1")  # 0 other, 1 letter, 2 digit, 3 white space, 4 plain punctuation, 5 other mark
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[*range(48, 58)]] = 2
_KIND[[32, 9, 10, 11, 12, 13]] = 3
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 4
_KIND[[i for i in range(33, 127) if not _KIND[i]]] = 5
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; a text without bytes or words has zeros where a share has no denominator."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype("f8")

    def sums(flag):
        upto = np.r_[0, np.cumsum(flag, dtype="i8")]
        return (upto[offsets[1:]] - upto[offsets[:-1]]).astype("f8")

    def share(a, b):
        return np.where(b > 0, a / np.maximum(b, 1), 0.0)

    kind = _KIND[data]
    letters, marks, plain = sums(kind == 1), sums(kind == 5), sums(kind == 4)
    stops = sums((data == 46) | (data == 33) | (data == 63))
    inside = ~IS_SPACE[data]
    solid = sums(inside)
    h, row = words(data, offsets)
    count = np.bincount(row, minlength=n).astype("f8")
    same_row = row[1:] == row[:-1]
    repeats = np.bincount(row[1:][same_row & (h[1:] == h[:-1])], minlength=n)
    def distinct(code, owner):
        order = np.lexsort((code, owner))
        c, o = code[order], owner[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(new)
        runs = np.diff(np.r_[at, len(c)])
        most = np.zeros(n)
        np.maximum.at(most, o[at], runs)
        return np.bincount(o[at], minlength=n).astype("f8"), most
    kinds, most = distinct(h, row)
    two = mix(h[:-1] * np.uint64(3) + h[1:])[same_row] if len(h) > 1 else np.zeros(0, "u8")
    pairs, _ = distinct(two, row[1:][same_row] if len(h) > 1 else np.zeros(0, "i8"))
    # words that end in or are a mark
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    ends[tails] = inside[tails]
    marked = sums(ends & (kind == 5))
    breaks = data == 10
    closing = breaks.copy()
    closing[tails] = True
    closing &= np.r_[False, inside[:-1]] | inside
    before = np.where(breaks, np.r_[np.zeros(1, "u1"), data[:-1]], data) if len(data) else data
    good = sums(closing & ((before == 46) | (before == 33) | (before == 63)))
    lines = sums(closing)
    return np.column_stack([
        share(letters, solid), share(sums(_UPPER[data]), letters), share(sums(kind == 2), solid), share(marks, solid),
        share(stops, count), share(solid, count), share(repeats, np.maximum(count - 1, 0)),
        np.where(count > 0, np.log1p(kinds) / np.log1p(np.maximum(count, 1)), 0.0), share(most, count), share(marked, count),
        share(good, lines), share(count, lines), share(sums(data == 124), count), np.log1p(size),
        share(pairs, np.maximum(count - 1, 0)),
    ])


def text_features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` (the text may be among them) and one double per feature, named f0, f1 and so on."""
    import pyarrow as pa

    read = keep if text in keep else [*keep, text]
    at = read.index(text)

    names = [f"f{i}" for i in range(len(FEATURES))]
    schema = docs.select(*keep).schema
    for name in names:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for first, last in slices(offsets):
                o = offsets[first : last + 1]
                x = describe(data[o[0] : o[-1]], o - o[0])
                cols = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(c) for c in x.T]], names=[*keep, *names])

    return docs.select(*read).mapInArrow(run, schema)


class PuClassifier:
    """Bin edges, weights and prior; ``fit`` learns them, ``score`` applies them."""

    def __init__(self, ridges: tuple[float, ...] = RIDGES, bins: int = BINS):
        self.ridges, self.bins = ridges, bins
        self.edges: list[list[float]] = []
        self.weights: np.ndarray | None = None
        self.prior: float | None = None

    def _basis(self, x: np.ndarray) -> np.ndarray:
        cols = [np.ones((len(x), 1))]
        for i, edges in enumerate(self.edges):
            at = np.searchsorted(np.array(edges), x[:, i], "right")
            cols.append((at[:, None] == np.arange(len(edges) + 1)[None, :]).astype("f8"))
        return np.hstack(cols)

    def fit(self, rows: DataFrame) -> "PuClassifier":
        """``rows``: f0..fk and ``positive`` (true for trusted positives; every row counts as unlabelled web text). Without
        positives or rows nothing is learned and every score is 0.5."""
        import pandas as pd

        names = [f"f{i}" for i in range(len(FEATURES))]
        probs = [i / self.bins for i in range(1, self.bins)] + [0.01, 0.03, 0.97, 0.99]
        found = rows.agg(F.sum(F.col("positive").cast("int")).alias("p"), *[F.percentile_approx(c, probs, 2000).alias(c) for c in names]).first()
        if not found["p"]:
            return self
        self.edges = [sorted(set(found[c])) for c in names]
        width = 1 + sum(len(e) + 1 for e in self.edges)

        def moments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((FOLDS, 2, width + 1, width))
            for part in parts:
                z = self._basis(part[names].to_numpy())
                fold, positive = part["fold"].to_numpy(), part["positive"].to_numpy()
                for i in range(FOLDS):
                    for k, x in enumerate((z[fold == i], z[(fold == i) & positive])):
                        total[i, k, :width] += x.T @ x
                        total[i, k, width, 0] += len(x)
            flat = total.ravel()
            at = np.flatnonzero(flat)
            yield pd.DataFrame({"cell": at, "value": flat[at]})

        # folds by the features, so equal texts are in one fold
        fold = F.pmod(F.xxhash64(*names), F.lit(FOLDS)).cast("int").alias("fold")
        sums = rows.select(*names, "positive", fold).mapInPandas(moments, "cell long, value double")
        got = sums.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        total = np.zeros(FOLDS * 2 * (width + 1) * width)
        total[got["cell"].to_numpy()] = got["value"].to_numpy()
        total = total.reshape(FOLDS, 2, width + 1, width)
        self._solve(total, 0.5)
        self.prior = self._estimate(rows, names)
        self._solve(total, self.prior)
        return self

    @staticmethod
    def _means(total: np.ndarray) -> np.ndarray:
        """Second moments of the unlabelled and of the positives; the bias is the first unknown, so row 0 holds the means."""
        width = total.shape[2]
        return total[:, :width] / np.maximum(total[:, width, 0], 1)[:, None, None]

    @staticmethod
    def _least(unl: np.ndarray, pos: np.ndarray, prior: float, ridge: float) -> np.ndarray:
        shrink = ridge * np.eye(len(unl))
        shrink[0, 0] = 1e-9  # the bias is free
        return np.linalg.solve(unl + shrink, 2 * prior * pos[0] - unl[0])

    def _solve(self, total: np.ndarray, prior: float) -> None:
        risk = {}
        for ridge in self.ridges:
            held = []
            for i in range(FOLDS):
                unl, pos = self._means(total.sum(0) - total[i])
                w = self._least(unl, pos, prior, ridge)
                unl, pos = self._means(total[i])
                held.append(-prior * w @ pos[0] + (1 + 2 * w @ unl[0] + w @ unl @ w) / 4)
            risk[ridge] = float(np.mean(held))
        ridge = min(risk, key=lambda r: (risk[r], -r))
        unl, pos = self._means(total.sum(0))
        for _ in range(12):
            w = self.weights = self._least(unl, pos, prior, ridge)
            loss = lambda m: (1 + 2 * w @ m[0] + w @ m @ w) / 4  # noqa: E731  of -g
            if loss(unl) - prior * loss(pos) >= 0:
                break
            ridge *= 4

    def _estimate(self, rows: DataFrame, names: list[str]) -> float:
        """The smallest ratio of unlabelled to positive mass above a score that a third of the positives reach."""
        cell = F.floor(F.least(F.greatest(self._score_column(names), F.lit(-1.0)), F.lit(1.999)) * (CELLS / 3) + CELLS / 3).cast("int")
        hist = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("u"), F.sum(F.col("positive").cast("int")).alias("p")).toPandas()
        hist = hist.sort_values("cell", ascending=False)
        u = hist["u"].cumsum().to_numpy() / hist["u"].sum()
        p = hist["p"].cumsum().to_numpy() / hist["p"].sum()
        ok = p >= 1 / 3
        return float(np.clip(np.min(u[ok] / p[ok]), 0.01, 0.99))

    def _score_column(self, names: list[str]) -> Column:
        """(1 + g) / 2 as a column expression."""
        total, at = F.lit(float(self.weights[0])), 1
        for name, edges in zip(names, self.edges):
            # the number of edges that are not above the value picks the weight
            bin_ = sum((F.when(F.col(name) >= e, 1).otherwise(0) for e in edges), F.lit(0))
            table = F.array(*[F.lit(float(w)) for w in self.weights[at : at + len(edges) + 1]])
            total = total + F.get(table, bin_)
            at += len(edges) + 1
        return (1 + total) / 2

    def score(self) -> Column:
        """Score from 0 to 1 over the columns f0..fk."""
        if self.weights is None:
            return F.lit(0.5)
        names = [f"f{i}" for i in range(len(FEATURES))]
        return F.least(F.greatest(self._score_column(names), F.lit(0.0)), F.lit(1.0))


def fit_quality(docs: DataFrame, labels: DataFrame, trainable: Column) -> tuple[PuClassifier, DataFrame]:
    """The classifier learned from rows where ``trainable`` holds, and the features of all rows, written once."""
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select(F.col("doc_id").alias("__good"))
    rows = materialise(text_features(docs.select("doc_id", "text"), ["doc_id"]))
    train = rows.filter(trainable).join(trusted, F.col("doc_id") == F.col("__good"), "left")
    return PuClassifier().fit(train.withColumn("positive", F.col("__good").isNotNull()).drop("__good")), rows


def score_quality(docs: DataFrame, labels: DataFrame, trainable: Column) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, learned from rows where ``trainable`` holds.

    Trusted positives are trainable rows whose labels (``doc_id``, ``quality``) are all 1; every trainable row is unlabelled
    web text. Labels, source and language are no inputs of a score. Null and empty texts are described by zeros and scored
    like any other; repeated rows are scored each; rows without ``doc_id`` are scored and never positive; without positives
    every score is 0.5. An empty table gives an empty result; further columns are ignored.
    """
    model, rows = fit_quality(docs, labels, trainable)
    return rows.select("doc_id", model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, trainable: Column, columns: list[str]) -> DataFrame:
    """Columns ``columns`` (``text`` among them) of the rows of ``docs`` that ``score_quality`` would predict as 1. Every row is
    judged where it lies, by its own text: texts are not shuffled, and rows without or with equal ids need no care."""
    model, _ = fit_quality(docs, labels, trainable)
    return text_features(docs, columns).filter(model.score() >= 0.5).select(*columns)
