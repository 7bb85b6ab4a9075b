"""Exact nearest neighbours by pivots, and the resamplers and classifier built on them.

Every base row belongs to the cell of its closest pivot, and cells lie in shards of bounded size. A query looks first in the shard
of its own cell; the distance of the k-th row found there bounds how far it must look, and by the triangle inequality it goes
on only to shards that can hold a nearer row. A shard's rows are read once into a task, and the queries are streamed past
them. A base row is shuffled once per round (and once more per ``QUERY_RUN`` queries that ask for its shard), a query once per
shard it must see. No pair leaves a task, nothing is capped, and the result is exact.

Copies are one vector: a vector keeps its k + 1 smallest keys, which are all that ties by key can name, and equal queries are asked
once, so a large group of equal rows adds neither pairs nor a hot shard.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.hashing import key_hash, key_uniform
from ..plans.session import materialise
from ..plans.skew import lookup_join
from .split import undersample

#: Base rows of a shard, and queries after which a shard is held by one more task.
SHARD_ROWS, QUERY_RUN = 1 << 15, 1 << 20
#: Distances a task holds at once.
CELLS = 1 << 22


def _matrix(series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in series]) if len(series) else np.empty((0, 0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by matrix products: right up to rounding."""
    d = a @ b.T
    d *= -2
    d += (a * a).sum(axis=1)[:, None]
    d += (b * b).sum(axis=1)[None, :]
    return np.maximum(d, 0.0, out=d)


def _slices(rows: int, wide: int):
    step = max(1, CELLS // max(1, wide))
    return [(i, min(rows, i + step)) for i in range(0, rows, step)]


def _cut(parts: Iterator[pd.DataFrame], step: int) -> Iterator[pd.DataFrame]:
    """Rows in pieces of at most ``step``, so that what a row makes of itself is never there for a whole batch."""
    for part in parts:
        for i in range(0, len(part), step):
            yield part.iloc[i : i + step]


def _best(q: np.ndarray, ids: np.ndarray, rows: np.ndarray, need: int):
    """(place in q, id, distance) of the ``need`` nearest rows of every query, ties by id. Products screen, differences decide."""
    out = []
    room = (rows * rows).sum(axis=1).max(initial=0.0)
    for a, b in _slices(len(q), len(rows)):
        near = _squares(q[a:b], rows)
        if len(rows) > need:
            limit = np.partition(near, need - 1, axis=1)[:, need - 1]
            at, row = np.nonzero(near <= (limit + 1e-12 * ((q[a:b] ** 2).sum(axis=1) + room))[:, None])
        else:
            at, row = (x.ravel() for x in np.indices(near.shape))
        step = max(1, CELLS // max(1, rows.shape[1]))
        d = [((q[a:b][at[i : i + step]] - rows[row[i : i + step]]) ** 2).sum(axis=1) for i in range(0, len(at), step)]
        d = np.sqrt(np.concatenate(d)) if d else np.zeros(0)
        order = np.lexsort((ids[row], d, at))
        at, row, d = at[order], row[order], d[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < need
        out.append((at[keep] + a, ids[row[keep]], d[keep]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0)]


def _kd_order(points: np.ndarray) -> np.ndarray:
    """An order in which near points are near: halves along the widest dimension."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= 2:
            out.extend(at.tolist())
            continue
        axis = np.ptp(points[at], axis=0).argmax()
        at = at[np.argsort(points[at, axis], kind="stable")]
        todo += [at[len(at) // 2 :], at[: len(at) // 2]]
    return np.array(out, dtype=np.int64)


class _Plan:
    """Where rows and queries go: pivots in an order that keeps near ones together, what their cells hold, and runs of cells
    as slots of at most ``SHARD_ROWS`` rows; a cell above that is a slot of several shards."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[_kd_order(pivots)]

    def hold(self, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.size, self.low, self.high = size, low, high
        self.slot = np.zeros(len(size), dtype=np.int64)
        starts, held = [], SHARD_ROWS + 1
        for cell, n in enumerate(size.tolist()):
            if held + n > SHARD_ROWS:
                starts.append(cell)
                held = 0
            held += n
            self.slot[cell] = len(starts) - 1
        self.starts = np.array(starts, dtype=np.int64)
        total = np.add.reduceat(size, self.starts)
        self.pieces = np.maximum(1, -(-total // SHARD_ROWS))
        self.first = np.cumsum(self.pieces) - self.pieces
        self.shards = int(self.pieces.sum())

    def distances(self, vec) -> np.ndarray:
        q = _matrix(vec)
        parts = [np.sqrt(((q[a:b, None, :] - self.pivots[None, :, :]) ** 2).sum(axis=2)) for a, b in _slices(len(q), self.pivots.size)]
        return np.vstack(parts)

    def home(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The shard of rows of these cells; a large cell is dealt by key."""
        slot = self.slot[cell]
        spread = (ids.astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[slot] + (spread % self.pieces[slot].astype("u8")).astype(np.int64)

    def live(self, d: np.ndarray, bound: np.ndarray):
        """(query, shard) that may hold a row nearer than the bound, for distances ``d`` to the pivots."""
        bound = (bound * (1 + 1e-9) + 1e-12)[:, None]
        cells = (self.size > 0)[None, :] & (d - self.high[None, :] <= bound) & (self.low[None, :] - d <= bound)
        row, slot = np.nonzero(np.logical_or.reduceat(cells, self.starts, axis=1))
        many = self.pieces[slot]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(row, many), np.repeat(self.first[slot], many) + within


def _search(base: DataFrame, queries: DataFrame, need: int, shards: int) -> DataFrame:
    """(id, neighbor, distance): the ``need`` nearest base rows of a shard for every query sent there."""
    import pyarrow as pa

    asked = queries.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > QUERY_RUN)
    # shards that more queries ask for than one task should see: at most one row per shard
    turns = F.broadcast(materialise(asked.select("shard", F.ceil(F.col("n") / QUERY_RUN).cast("int").alias("turns"))))
    several = F.coalesce("turns", F.lit(1))
    rows = base.join(turns, "shard", "left").select("shard", F.explode(F.sequence(F.lit(0), several - 1)).alias("turn"), F.lit(0).alias("kind"), "id", "vec")
    calls = queries.join(turns, "shard", "left").select("shard", F.pmod(F.xxhash64("id"), several).cast("int").alias("turn"), F.lit(1).alias("kind"), "id", "vec")
    parts = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards)

    def stream(batches):
        now, ids, vectors, held = None, [], [], None
        for batch in batches:
            shard, turn, kind, key = (batch.column(i).to_numpy() for i in range(4))
            flat = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            vec = flat.reshape(len(key), -1)
            code = np.stack([shard, turn, kind])
            cuts = np.r_[0, np.flatnonzero((code[:, 1:] != code[:, :-1]).any(axis=0)) + 1, len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if (shard[a], turn[a]) != now:
                    now, ids, vectors, held = (shard[a], turn[a]), [], [], None
                if kind[a] == 0:
                    ids.append(key[a:b])
                    vectors.append(vec[a:b])
                elif ids:
                    held = held or (np.concatenate(ids), np.concatenate(vectors))
                    at, near, d = _best(vec[a:b], *held, need)
                    yield pa.RecordBatch.from_arrays([pa.array(key[a:b][at]), pa.array(near), pa.array(d)], ["id", "neighbor", "distance"])

    both = rows.unionByName(calls).repartition(parts, "shard", "turn").sortWithinPartitions("shard", "turn", "kind", "id")
    return both.mapInArrow(stream, "id long, neighbor long, distance double")


def _nearest_vectors(queries: DataFrame, base: DataFrame, need: int) -> DataFrame:
    """(id, neighbor, distance) of the ``need`` nearest rows of (id, vec) base rows, and some more, for (id, vec) queries."""
    n = base.count()
    if not n:
        return base.select("id", F.col("id").alias("neighbor"), F.lit(0.0).alias("distance"))
    # the square root of n pivots: as many distances to pivots as rows in a cell
    drawn = base.orderBy(F.xxhash64("id"), "id").limit(math.isqrt(n - 1) + 1).collect()
    plan = _Plan(_matrix([r["vec"] for r in drawn]))

    dim, most = plan.pivots.shape[1], CELLS

    def cut(parts: Iterator[pd.DataFrame], wide: int) -> Iterator[pd.DataFrame]:
        return _cut(parts, max(1, most // wide))

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in cut(parts, len(plan.pivots) + dim):
            d = plan.distances(part["vec"])
            yield part.assign(cell=d.argmin(axis=1).astype("int32"), far=d.min(axis=1))

    cells = materialise(base.mapInPandas(assign, "id long, vec array<double>, cell int, far double"))
    pivots = len(plan.pivots)
    low, high, size = np.full(pivots, np.inf), np.full(pivots, -np.inf), np.zeros(pivots, dtype=np.int64)
    # three numbers per pivot
    for s in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")).collect():
        low[s["cell"]], high[s["cell"]], size[s["cell"]] = s["lo"], s["hi"], s["n"]
    plan.hold(size, low, high)

    def settle(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"shard": plan.home(part["cell"].to_numpy(), part["id"].to_numpy()), "id": part["id"], "vec": part["vec"]})

    def call(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in cut(parts, len(plan.pivots) + dim):
            d = plan.distances(part["vec"])
            d[:, plan.size == 0] = np.inf
            yield pd.DataFrame({"shard": plan.home(d.argmin(axis=1), part["id"].to_numpy()), "id": part["id"], "vec": part["vec"]})

    def go_on(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a query may have to go on to every shard, with its vector
        for part in cut(parts, len(plan.pivots) + plan.shards * (dim + 1)):
            row, shard = plan.live(plan.distances(part["vec"]), part["bound"].to_numpy("f8"))
            other = shard != part["shard"].to_numpy()[row]
            row, shard = row[other], shard[other]
            yield pd.DataFrame({"shard": shard, "id": part["id"].to_numpy()[row], "vec": part["vec"].to_numpy()[row]})

    schema = "shard long, id long, vec array<double>"
    held = materialise(cells.mapInPandas(settle, schema))
    first = materialise(queries.mapInPandas(call, schema))
    found = materialise(_search(held, first, need, plan.shards))
    reach = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
    bound = F.when(F.col("n") >= need, F.col("far")).otherwise(float("inf"))
    rest = first.join(reach.select("id", bound.alias("bound")), "id", "left").na.fill(float("inf"), ["bound"])
    calls = materialise(rest.mapInPandas(go_on, schema))
    return found.unionByName(_search(held, calls, need, plan.shards))


def knn(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, exclude_self: bool = False) -> DataFrame:
    """The k nearest base rows of every query as (query key, ``neighbor``, ``distance``, ``rank``), ties by key. Rows whose key or
    vector is null take no part."""
    plain = lambda df: df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).na.drop()
    base, queries = materialise(plain(base)), materialise(plain(queries))
    need = k + 1 if exclude_self else k
    same = W.partitionBy("vec").orderBy("id")
    lowest = base.withColumn("r", F.row_number().over(same)).filter(F.col("r") <= need).drop("r")
    groups = materialise(queries.groupBy("vec").agg(F.min("id").alias("group"), F.count(F.lit(1)).alias("n")))
    found = _nearest_vectors(groups.select(F.col("group").alias("id"), "vec"), materialise(lowest), need)
    best = W.partitionBy("id").orderBy("distance", "neighbor")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= need)
    item = F.struct("rank", "neighbor", "distance")
    lists = materialise(ranked.groupBy(F.col("id").alias("group")).agg(F.sort_array(F.collect_list(item)).alias("near")))
    # a query that shares its vector with others takes their list, without itself
    alone = groups.filter("n = 1").select(F.col("group").alias("id"), "group")
    shared = groups.filter("n > 1").select("vec", "group", "n")
    copies = lookup_join(queries, shared.drop("n"), ["vec"], "inner", ["id"], shared.drop("group"))
    members = alone.unionByName(copies.select("id", "group"))
    wide = lookup_join(members, lists, ["group"], "inner", ["id"], ready=True)
    near = F.filter("near", lambda x: x["neighbor"] != F.col("id")) if exclude_self else F.col("near")
    out = wide.select("id", F.posexplode(F.slice(near, 1, k)).alias("at", "x"))
    return out.select(F.col("id").alias(key), F.col("x.neighbor").alias("neighbor"), F.col("x.distance").alias("distance"), (F.col("at") + 1).alias("rank"))


def _with_label(found: DataFrame, base: DataFrame, key: str, y: str) -> DataFrame:
    labels = base.select(F.col(key).alias("neighbor"), F.col(y).alias("__vote"))
    # a row that is near to very many queries is a hot key
    return lookup_join(found, labels, ["neighbor"], "inner", [key])


def votes(found: DataFrame, base: DataFrame, key: str, y: str) -> DataFrame:
    """Most frequent label among the neighbours of each query, the lowest one on ties."""
    counts = _with_label(found, base, key, y).groupBy(key, "__vote").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("__vote").alias("v"))).getField("v").alias("prediction"))


def knn_classify(train: DataFrame, test: DataFrame, key: str, vector: str, y: str, k: int = 5) -> DataFrame:
    return votes(knn(test, train, key, vector, k), train, key, y)


def edited_neighbors(df: DataFrame, key: str, vector: str, y: str, k: int = 3, repeats: int = 1, rule: str = "mode") -> DataFrame:
    """Drop rows that their k neighbours contradict: by majority (``mode``) or when any of them differs (``all``).
    Rows of the smallest class are kept. The repeated form stops when a pass drops nothing or a class would vanish."""
    rows = df
    for _ in range(repeats):
        sizes = rows.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
        rare = sizes.orderBy("n", y).first()[y]
        found = knn(rows.filter(F.col(y) != rare), rows, key, vector, k, exclude_self=True)
        own = rows.select(key, F.col(y).alias("__own"))
        if rule == "mode":
            bad = votes(found, rows, key, y).join(own, key).filter(F.col("prediction") != F.col("__own"))
        else:
            bad = _with_label(found, rows, key, y).join(own, key).filter(F.col("__vote") != F.col("__own"))
        bad = materialise(bad.select(key).distinct())
        if bad.isEmpty():
            break
        kept = materialise(rows.join(bad, key, "left_anti"))
        if repeats > 1 and kept.select(y).distinct().count() < sizes.count():
            break
        rows = kept
    return rows


def smote_rates(df: DataFrame, y: str, high: float = 0.6, low: float = 0.4) -> tuple[float, float]:
    """Over- and under-sampling factors from the largest and smallest class, rounded to one decimal."""
    n = [r["n"] for r in df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).collect()]
    over = (high * max(n) - min(n)) / min(n)
    return round(over, 1), round(low * max(n) / (min(n) * over), 1) if over else 0.0


def smote(df: DataFrame, key: str, vector: str, y: str, minority, k: int = 5, over: float = 1.0, under: float | None = None):
    """Synthetic minority rows between a row and one of its k nearest minority rows, ``over`` of them per row; with
    ``under`` the other classes are cut to ``under`` rows per synthetic row. Draws come from key hashes."""
    rare = df.filter(F.col(y) == minority)
    links = knn(rare, rare, key, vector, k, exclude_self=True)
    near = links.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("__near"))
    whole, part = int(over), over - int(over)
    extra = F.when(key_uniform(key, "smote-extra") < part, 1).otherwise(0)
    copies = near.withColumn("__copies", F.lit(whole) + extra).filter(F.col("__copies") > 0).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))
    )
    tag = F.concat_ws(":", key, "__copy")
    picked = copies.select(
        key,
        "__copy",
        F.element_at("__near", (key_hash(tag, "smote-pick") % F.size("__near") + 1).cast("int"))["neighbor"].alias("__to"),
        key_uniform(tag, "smote-gap").alias("__gap"),
    )
    start = rare.select(key, F.col(vector).alias("__a"))
    end = rare.select(F.col(key).alias("__to"), F.col(vector).alias("__b"))
    moved = lookup_join(picked.join(start, key), end, ["__to"], "inner", [key, "__copy"])
    value = F.zip_with(F.col("__a").cast("array<double>"), F.col("__b").cast("array<double>"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    made = moved.select(
        F.col(key),
        F.transform(value, lambda p: p["a"] + F.col("__gap") * (p["b"] - p["a"])).alias(vector),
        F.lit(minority).alias(y),
        F.col("__copy").alias("copy"),
    )
    real = df.select(key, F.col(vector).cast("array<double>").alias(vector), y, F.lit(0).alias("copy"))
    if under is not None:
        n_new = materialise(made).count()
        others = real.filter(F.col(y) != minority)
        total = others.count()
        share = min(1.0, under * n_new / total) if total else 1.0
        classes = [r[y] for r in others.select(y).distinct().collect()]
        real = real.filter(F.col(y) == minority).unionByName(undersample(others, key, y, multipliers={c: share for c in classes}))
    return real.unionByName(made)
