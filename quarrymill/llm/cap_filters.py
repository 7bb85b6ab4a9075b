"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a unit vector belongs to it when their inner product exceeds a threshold. The directions form a random
product code: a rotated vector is cut into parts, each part has some hundred random unit vectors, and every combination is a
direction. A vector is list-decoded: combinations are built part by part and dropped once the best rest cannot lift them over
the threshold, so the exceeding directions are found without looking at the others. Two vectors of cosine 0.9 exceed a common
direction with probability ``recall``; the threshold is set for that by drawing such pairs. Vectors are joined on filters and
verified by their cosine.

Equal vectors are one node with a multiplicity. A filter shared by very many nodes is compared in blocks of bounded size. A
pair found in several filters is counted in the first of them only; blocks return counts and spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..plans.session import materialise
from .components import components
from .vectors import usable

RECALL = 0.97
#: Directions per distinct vector. Fewer mean fewer filters a vector is sent to, and more vectors to compare in each.
DIRECTIONS_A_ROW = 2
MOST_IN_A_PART = 2048
BLOCK = 1024
CALL_ROWS = 4000


class ProductCode:
    """Random product code for unit vectors of ``dim`` components, sized for ``rows`` vectors."""

    def __init__(self, dim: int, rows: int, cosine: float, recall: float = RECALL, seed: int = 5):
        rng = np.random.default_rng(seed)
        wanted = max(64, int(DIRECTIONS_A_ROW * rows))
        self.parts = 2
        while wanted ** (1 / self.parts) > MOST_IN_A_PART and self.parts < dim:
            self.parts += 1
        self.parts = min(self.parts, dim)
        self.each = max(2, math.ceil(wanted ** (1 / self.parts)))
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = np.linspace(0, dim, self.parts + 1).astype(int)
        self.words = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            w = rng.normal(size=(self.each, b - a))
            self.words.append(w / np.linalg.norm(w, axis=1, keepdims=True))
        self.threshold = 0.0
        self._calibrate(rng, dim, cosine, recall)

    def scores(self, x: np.ndarray) -> list[np.ndarray]:
        y = x @ self.rotation
        return [y[:, a:b] @ w.T for a, b, w in zip(self.cuts, self.cuts[1:], self.words)]

    def decode(self, scores: list[np.ndarray], threshold: float | None = None) -> np.ndarray:
        """Sorted directions that one vector exceeds, given its scores part by part."""
        least = self.threshold if threshold is None else threshold
        rest = [0.0]
        for s in reversed(scores[1:]):
            rest.append(rest[-1] + float(s.max()))
        rest.reverse()
        code, total = np.zeros(1, "i8"), np.zeros(1)
        for s, best in zip(scores, rest):
            order = np.argsort(-s)
            ranked = s[order]
            # for each partial sum, how many words of this part keep it in reach
            many = np.searchsorted(-ranked, total + best - least, "right")
            at = np.repeat(np.arange(len(code)), many)
            k = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            code, total = code[at] * self.each + order[k], total[at] + ranked[k]
        return np.sort(code[total >= least])

    def _total(self, scores: list[np.ndarray], code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code))
        for s in reversed(scores):
            code, word = np.divmod(code, self.each)
            out += s[word]
        return out

    def _calibrate(self, rng, dim: int, cosine: float, recall: float, pairs: int = 600) -> None:
        """The threshold that this share of pairs of the given cosine exceed in a common direction."""
        x = rng.normal(size=(pairs, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.normal(size=(pairs, dim))
        y -= (y * x).sum(1, keepdims=True) * x
        y = cosine * x + math.sqrt(1 - cosine * cosine) * y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
        sx, sy = self.scores(x), self.scores(y)
        reach = []
        for i in range(pairs):
            a, b = [s[i] for s in sx], [s[i] for s in sy]
            top = sum(float(s.max()) for s in a)
            for down in (0.2, 0.4, 1.0, 3.0):
                code = self.decode(a, top * (1 - down))
                low = np.minimum(self._total(a, code), self._total(b, code))
                best = float(low.max()) if len(low) else -np.inf
                if best >= top * (1 - down):  # a direction not decoded cannot do better
                    break
            reach.append(best)
        self.threshold = float(np.quantile(reach, 1 - recall))


def pack_vector(v: np.ndarray) -> bytes:
    """Four bytes a component where they hold the value exactly, else eight."""
    short = v.astype("<f4")
    return b"4" + short.tobytes() if (short == v).all() else b"8" + v.astype("<f8").tobytes()


def unpack(packed) -> np.ndarray:
    """Unit vectors, as rows, of packed vectors."""
    x = np.array([np.frombuffer(v, "<f4" if v[:1] == b"4" else "<f8", offset=1).astype("f8") for v in packed])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _spanning(near: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each place of a symmetric matrix of links."""
    label = np.arange(len(near))
    masked = np.where(near, 0, len(near))
    while True:
        low = np.minimum(label, np.minimum.reduce(masked + label[None, :], axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compare(part, cosine: float, code: ProductCode):
    """Of the blocks of one call: kind 0, (node, nodes' copies linked with it); kind 1, a link (a, b) of a spanning set."""
    import pandas as pd

    part = part.sort_values(["filter", "lo", "hi", "node"], kind="stable")
    f, lo, hi = (part[c].to_numpy("i8") for c in ("filter", "lo", "hi"))
    node, mult, block = (part[c].to_numpy("i8") for c in ("node", "mult", "block"))
    x = unpack(part["v"])
    held: dict[int, np.ndarray] = {}

    def filters(i: int) -> np.ndarray:
        """Directions of a row, decoded again: only rows that have links are asked for."""
        if node[i] not in held:
            held[node[i]] = code.decode([s[0] for s in code.scores(x[i : i + 1])])
        return held[node[i]]

    new = np.r_[True, (f[1:] != f[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(f)])
    group = np.cumsum(new) - 1
    links = np.zeros(len(f), "i8")
    ea, eb = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
    small = count[group] <= 48
    at = np.flatnonzero(small)
    g, xs = group[at], x[at]
    for step in range(1, 48):
        hit = np.flatnonzero(g[step:] == g[:-step]) if len(at) > step else np.zeros(0, "i8")
        if not len(hit):
            break
        good = hit[np.einsum("ij,ij->i", xs[hit], xs[hit + step]) >= cosine]
        for i, j in zip(at[good].tolist(), at[good + step].tolist()):
            if lo[i] != hi[i] and block[i] == block[j]:
                continue
            common = np.intersect1d(filters(i), filters(j), assume_unique=True)
            if len(common) and common[0] == f[i]:
                links[i] += mult[j]
                links[j] += mult[i]
                ea.append(node[i : i + 1])
                eb.append(node[j : j + 1])
    for a, n in zip(first[count > 48].tolist(), count[count > 48].tolist()):
        rows = np.arange(a, a + n)
        near = x[rows] @ x[rows].T >= cosine
        np.fill_diagonal(near, False)
        if lo[a] != hi[a]:
            near &= block[rows][:, None] != block[rows][None, :]
        busy = np.flatnonzero(near.any(1))
        if not len(busy):
            continue
        rows, near = rows[busy], near[np.ix_(busy, busy)]
        label = _spanning(near)
        ea.append(node[rows])
        eb.append(node[rows[label]])
        # pairs that an earlier filter holds are counted there
        before = [filters(r)[filters(r) < f[a]] for r in rows]
        seen, place = np.unique(np.concatenate(before), return_inverse=True)
        inside = np.zeros((len(rows), len(seen)), "f4")
        inside[np.repeat(np.arange(len(rows)), [len(b) for b in before]), place] = 1
        own = near & (inside @ inside.T == 0)
        links[rows] += own @ mult[rows]
    some = np.flatnonzero(links)
    a, b = np.concatenate(ea), np.concatenate(eb)
    return pd.DataFrame({
        "kind": np.r_[np.zeros(len(some), "i4"), np.ones(len(a), "i4")],
        "a": np.r_[node[some], a], "b": np.r_[links[some], b],
    })


def near_vectors(vectors: DataFrame, cosine: float = 0.9, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``: other rows linked directly, the smallest id reachable
    by links, and whether that is the row's own. Links are pairs found with a cosine, in double precision, of at least
    ``cosine``; each such pair is found with probability ``RECALL`` or more, equal vectors always.

    Vectors that are null, empty, zero, or hold null or non-finite components, or have another length than most, link with
    nothing, and neither do rows without an id (their ``component_id`` is null and ``kept`` false). Repeated rows are rows of
    their own and link with each other. An empty table gives an empty result; further columns are ignored.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    rows = usable(vectors, key, column)
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(3), "v")})
    nodes = materialise(rows.groupBy("h1", "h2").agg(
        F.min("key").alias("node"), F.count(F.lit(1)).alias("mult"), F.first("v").alias("v"), F.first("norm").alias("norm")
    ))
    shape = nodes.agg(F.count(F.lit(1)).alias("n"), F.first(F.size("v")).alias("d"), F.sum("mult").alias("all")).first()
    ids = vectors.select(F.col(key).cast("long").alias("vec_id"))
    if not shape["n"]:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    code = ProductCode(shape["d"], shape["n"], cosine)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                v = some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
                packed = [pack_vector(x) for x in v]
                scores = code.scores(unpack(packed))
                found = [code.decode([s[i] for s in scores]).astype("<i8") for i in range(len(some))]
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array(packed, pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ], names=["node", "mult", "packed", "filters"])

    decoded = nodes.select("node", "mult", "v").mapInArrow(decode, "node long, mult long, packed binary, filters array<bigint>")
    decoded = materialise(decoded)
    held = decoded.select("node", F.explode("filters").alias("filter"))
    shared = held.groupBy("filter").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialise(shared.select("filter", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), "size"))
    volume = shared.agg(F.coalesce(F.sum(F.col("size") * F.col("blocks")), F.lit(0))).first()[0]
    calls = int(volume // CALL_ROWS) + 1
    placed = held.join(shared, "filter")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    wide = F.when(F.col("blocks") > 1, F.xxhash64("filter", "lo", "hi")).otherwise(F.pmod(F.xxhash64("filter"), F.lit(calls)))
    placed = placed.withColumn("call", wide).select("node", "filter", "block", "lo", "hi", "call")
    ready = placed.join(decoded.select("node", "mult", F.col("packed").alias("v")), "node")

    def compare(part):
        return _compare(part, cosine, code)

    found = materialise(ready.groupBy("call").applyInPandas(compare, "kind int, a long, b long"))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("more"))
    comp = components(found.filter("kind = 1").select("a", "b"))
    about = nodes.select("h1", "h2", "node", "mult").join(counts, "node", "left").join(comp, "node", "left")
    about = materialise(about.select(
        "h1", "h2", "mult", (F.col("mult") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    ))
    # copies of one vector may be a third of all rows: such vectors are few and looked up by broadcast
    floor = max(1000, int(shape["all"]) // 1000)
    often = about.filter(F.col("mult") >= floor).select("h1", "h2", F.col("n_links").alias("hot_links"), F.col("component_id").alias("hot_component"))
    seldom = about.filter(F.col("mult") < floor).select("h1", "h2", "n_links", "component_id")
    v = F.col(column).cast("array<double>")
    out = vectors.select(F.col(key).cast("long").alias("vec_id"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(3), v).alias("h2"))
    out = out.join(F.broadcast(often), ["h1", "h2"], "left")
    out = out.withColumn("h1", F.when(F.col("hot_component").isNull() & F.col("vec_id").isNotNull(), F.col("h1")))
    out = out.join(seldom, ["h1", "h2"], "left")
    has_id = F.col("vec_id").isNotNull()
    out = out.withColumn("component_id", F.when(has_id, F.coalesce("hot_component", "component_id", "vec_id")))
    return out.select(
        "vec_id",
        F.when(has_id, F.coalesce("hot_links", "n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
