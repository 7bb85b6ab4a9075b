"""Nearest neighbours by largest inner product, over low-dimensional stable projections indexed by a kd-tree.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm (a query gets 0): then the order of distances
is the order of inner products. A Gaussian projection to a few dimensions keeps distances in distribution: projected over true
squared distance is chi-square. The index is a kd-tree over projected vectors; its splits come from a bounded sample, and
every row is put into a leaf. A leaf is held in blocks of bounded size, each with a kd-tree of its own, so equal vectors by the
million fill many blocks.

A query first searches the leaf it lies in, which bounds the distance d of its k-th neighbour. It then visits the leaves whose
box is nearer in projection than sqrt(q) * d, q being the chi-square quantile of the stopping test. Inside a block, rows are
taken in order of projected distance and verified, and the walk ends once projected distance^2 >= q * d^2 for the d so far: a
nearer row that has not been seen by then would have to exceed its quantile. So each true neighbour is found with
probability ``confidence`` at least.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.session import materialise
from .vectors import usable

#: Sample of rows that the tree's splits are fitted on; every row is indexed.
SAMPLE_ROWS = 20_000
PROJECTED = 10
CONFIDENCE = 0.98
LEAF_ROWS = 4096
BLOCK_ROWS = 2048
BLOCK_QUERIES = 512
MOST_LEAVES = 4096


def chi_square_quantile(p: float, m: int) -> float:
    """Of an even number of degrees of freedom, by bisection on the closed form."""
    if m % 2:
        raise ValueError("projected dimensions must be even")
    cdf = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


class KdTree:
    """Median splits over points; ``depth`` levels, leaves numbered left to right."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.dim = np.zeros(inner, "i4")
        self.cut = np.full(inner, np.inf)
        parts = [points]
        for level in range(depth):
            nxt = []
            for i, part in enumerate(parts):
                node = (1 << level) - 1 + i
                if len(part) > 1:
                    dim = int(np.argmax(part.max(0) - part.min(0)))
                    cut = float(np.median(part[:, dim]))
                    self.dim[node], self.cut[node] = dim, cut
                    right = part[:, dim] > cut
                    nxt += [part[~right], part[right]]
                else:
                    nxt += [part, part[:0]]
            parts = nxt

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), "i8")
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.dim[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)

    def reach(self, points: np.ndarray) -> np.ndarray:
        """Squared distance from each point to each leaf's box: points by leaves. The offset in a dimension is replaced when
        a split of the same dimension comes closer, so only the side behind the split moves away."""
        n, m = points.shape
        low = np.full((1, m), -np.inf)
        high = np.full((1, m), np.inf)
        for level in range(self.depth):
            nodes = np.arange((1 << level) - 1, (1 << (level + 1)) - 1)
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            at = np.arange(len(nodes))
            dim, cut = self.dim[nodes], self.cut[nodes]
            high[2 * at, dim] = np.minimum(high[2 * at, dim], cut)
            low[2 * at + 1, dim] = np.maximum(low[2 * at + 1, dim], cut)
        out = np.zeros((n, len(low)))
        for d in range(m):
            x = points[:, d : d + 1]
            out += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0) ** 2
        return out


def search_block(rows, queries, k: int, quantile: float, bucket: int = 256):
    """Search one block for a set of queries. ``rows``: (ids, vectors, lift^2, projections); ``queries``: (ids, vectors, bound,
    projections), bound being the k-th squared distance known so far. Returns (query, id, score) arrays.

    The block's buckets are taken in order of their distance in projection; a query takes part as long as its stopping test
    allows, and verifies the rows that the test leaves. Products of all of them at once only tell which rows can matter; the
    scores returned are computed row by row, so equal vectors have equal scores wherever they stand.
    """
    ids, x, lift2, px = rows
    qid, q, bound, pq = queries
    depth = max(0, math.ceil(math.log2(max(1, len(ids)) / bucket)))
    tree = KdTree(px, depth)
    leaf = tree.leaf(px)
    order = np.argsort(leaf, kind="stable")
    ends = np.searchsorted(leaf[order], np.arange((1 << depth) + 1))
    reach = tree.reach(pq)
    q2 = (q * q).sum(1)
    pq2, px2 = (pq * pq).sum(1), (px * px).sum(1)
    slack = 1e-9 * max(1.0, lift2)
    found_i = [np.zeros(0, "i8")] * len(qid)
    found_s = [np.zeros(0)] * len(qid)
    d2 = bound.astype("f8").copy()
    least = np.where(np.isfinite(d2), (q2 + lift2 - d2) / 2, -np.inf)  # a score below this cannot be among the k best
    for b in np.argsort(reach.min(0), kind="stable"):
        at = order[ends[b] : ends[b + 1]]
        act = np.flatnonzero(reach[:, b] <= quantile * d2 + slack)
        if not len(at) or not len(act):
            continue
        near = pq2[act, None] + px2[at][None, :] - 2 * pq[act] @ px[at].T
        able = (near <= quantile * d2[act, None] + slack) & (q[act] @ x[at].T >= least[act, None] - slack)
        able &= ids[at][None, :] != qid[act, None]
        for i in np.flatnonzero(able.any(1)):
            j, rows_ = act[i], at[able[i]]
            i_all = np.r_[found_i[j], ids[rows_]]
            s_all = np.r_[found_s[j], (x[rows_] * q[j]).sum(1)]
            keep = np.lexsort((i_all, -s_all))[:k]
            found_i[j], found_s[j] = i_all[keep], s_all[keep]
            if len(keep) == k:
                least[j] = max(least[j], s_all[keep[-1]])
                d2[j] = min(d2[j], max(q2[j] + lift2 - 2 * s_all[keep[-1]], 0.0))
    sizes = [len(x) for x in found_i]
    return np.repeat(qid, sizes), np.concatenate(found_i), np.concatenate(found_s)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", column: str = "embedding",
    projected: int = PROJECTED, confidence: float = CONFIDENCE, seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable row where ``is_query`` holds, the ``k`` rows found nearest by inner
    product in double precision, its own id excepted, ties to the smaller id; all candidates, if there are fewer.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, as queries or candidates; so do rows
    without a key and vectors of another length than most. Repeated keys are one row (any of their vectors; the table is
    meant to have unique keys). Without usable rows the result is empty. Further columns are ignored.
    """
    import pandas as pd

    rows = usable(vectors, key, column).dropDuplicates(["key"])
    marks = vectors.filter(is_query).select(F.col(key).cast("long").alias("key")).distinct().withColumn("asks", F.lit(True))
    rows = materialise(rows.join(marks, "key", "left").withColumn("asks", F.coalesce("asks", F.lit(False))))
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m"), F.first(F.size("v")).alias("d")).first()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not shape["n"]:
        return vectors.sparkSession.createDataFrame([], out_schema)
    largest2 = float(shape["m"]) ** 2
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(shape["d"] + 1, projected))
    quantile = chi_square_quantile(confidence, projected)

    def project(x, lift):
        return x @ directions[:-1] + np.sqrt(np.maximum(lift, 0))[:, None] * directions[-1]

    # the sample: the rows of smallest key hash
    sample = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select("v", "norm").toPandas()
    sx = np.array(sample["v"].tolist())
    depth = min(int(math.log2(MOST_LEAVES)), max(0, math.ceil(math.log2(shape["n"] / LEAF_ROWS))))
    tree = KdTree(project(sx, largest2 - sample["norm"].to_numpy() ** 2), depth)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            x = np.array(part["v"].tolist(), "f8").reshape(len(part), -1)
            part["leaf"] = tree.leaf(project(x, largest2 - part["norm"].to_numpy() ** 2)).astype("i4")
            part["home"] = tree.leaf(project(x, np.zeros(len(part)))).astype("i4")
            yield part

    kinds = "key long, v array<double>, norm double, asks boolean, leaf int, home int"
    rows = materialise(rows.mapInPandas(place, kinds))
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = F.broadcast(materialise(sizes))  # one row a leaf, at most MOST_LEAVES
    held = rows.join(sizes, "leaf").select(
        "leaf", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), "key", "v", "norm"
    )
    asks = rows.filter("asks").select("key", "v", "home")
    crowd = asks.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("crowds"))
    asks = asks.join(F.broadcast(materialise(crowd)), "home")
    asks = asks.withColumn("crowd", F.pmod(F.xxhash64("key", F.lit(1)), F.col("crowds")).cast("int"))
    asks = materialise(asks.select("key", "v", "home", "crowd"))

    def visit(requests: DataFrame) -> DataFrame:
        """(query_id, vec_id, score, d2) found for requests (leaf, home, crowd, key, v, bound): groups of queries from one
        home against the blocks of a leaf."""
        calls = requests.select("leaf", "home", "crowd").distinct()
        left = requests.join(sizes, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        right = held.join(calls, "leaf")
        by = ["leaf", "block", "home", "crowd"]
        right = right.select(*[F.col(c).alias(f"{c}_") for c in by], "key", "v", "norm")

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "i8", "vec_id": "i8", "score": "f8"})
            if not len(a) or not len(b):
                return none
            x, q = np.array(b["v"].tolist(), "f8"), np.array(a["v"].tolist(), "f8")
            px = project(x, largest2 - b["norm"].to_numpy() ** 2)
            got = search_block(
                (b["key"].to_numpy("i8"), x, largest2, px),
                (a["key"].to_numpy("i8"), q, a["bound"].to_numpy("f8"), project(q, np.zeros(len(q)))), k, quantile,
            )
            return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), got)))

        return left.groupBy(*by).cogroup(right.groupBy(*[f"{c}_" for c in by])).applyInPandas(run, "query_id long, vec_id long, score double")

    first = visit(asks.withColumns({"leaf": F.col("home"), "bound": F.lit(float("inf"))}))
    first = materialise(first)
    lengths = rows.filter("asks").select(F.col("key").alias("query_id"), (F.col("norm") * F.col("norm")).alias("q2"))

    def kth(found: DataFrame) -> DataFrame:
        """The k-th best score of each query, where it has so many."""
        best = F.sort_array(F.collect_list("score"), asc=False)
        return found.groupBy("query_id").agg(F.get(best, F.lit(k - 1)).alias("edge"))

    bounds = kth(first).join(lengths, "query_id", "right").select(
        F.col("query_id").alias("key"),
        F.coalesce(F.greatest(F.col("q2") + largest2 - 2 * F.col("edge"), F.lit(0.0)), F.lit(float("inf"))).alias("bound"),
    )

    def widen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for i in range(0, len(part), 256):
                some = part.iloc[i : i + 256]
                q = np.array(some["v"].tolist(), "f8")
                reach = tree.reach(project(q, np.zeros(len(q))))
                near = reach <= (quantile * some["bound"].to_numpy() + 1e-9 * max(1.0, largest2))[:, None]
                near[np.arange(len(some)), some["home"].to_numpy()] = False
                at, leaf = np.nonzero(near)
                out = some.iloc[at].copy()
                out["leaf"] = leaf.astype("i4")
                yield out

    wide = asks.join(bounds, "key").select("key", "v", "home", "crowd", "bound")
    wide = wide.mapInPandas(widen, "key long, v array<double>, home int, crowd int, bound double, leaf int")
    found = first.unionByName(visit(wide))

    # each group returned at most k rows a query; the best k of them all
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("id")))), 1, k)
    top = found.groupBy("query_id").agg(best.alias("best"))
    ranked = top.select("query_id", F.posexplode("best").alias("at", "one"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), (-F.col("one.s")).alias("score")
    )
