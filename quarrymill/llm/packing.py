"""Best-fit packing of texts into sequences of several permitted lengths.

Texts are dealt over shards of bounded size by hash; a shard packs its pieces in one task, longest first. A piece goes to
the open bin that it fills best. If it fits in none, a bin of the capacity of least cost for each token is opened: a
sequence of c tokens costs c, a fixed overhead, and c * c / ATTENTION for attention. The tokens it will hold are foreseen
from the lengths still to be placed and not yet foreseen in an open bin: the largest that fits, again and again. So short
sequences are opened for short texts, and long ones where a text needs the length or short ones would stay badly filled.
At the end every bin shrinks to the smallest capacity that holds its contents. Only the last bins of a shard can be badly
filled, so sharding costs about one bin in some thousands.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.session import materialise
from .wordhash import IS_SPACE, buffers, slices

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its tokens, in tokens.
OVERHEAD = 128
#: Length at which the attention of a sequence costs as much as the rest: six times the width of a model of 4,096.
ATTENTION = 24_576
SHARD_PIECES = 50_000


def price(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """Cost of one sequence of this length."""
    return capacity + overhead + capacity * capacity / attention


def pack(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION
):
    """(bin, start) of every length, taken in the order given, and (used, capacity) of every bin."""
    capacities = sorted(capacities)
    costs = {c: price(c, overhead, attention) for c in capacities}
    waiting, promised = Counter(lengths), Counter()  # pieces still to be placed: free ones, and those foreseen in open bins
    lengths_mask = sum(1 << n for n in waiting)  # bit n: a free piece of n tokens
    free: dict[int, list[int]] = {}
    mask = 0  # bit r: a bin with r places left
    used: list[int] = []
    room: list[int] = []
    placed = []

    def take(n: int, k: int) -> None:
        nonlocal lengths_mask
        waiting[n] -= k
        if not waiting[n]:
            lengths_mask &= ~(1 << n)

    def foreseen(space: int) -> list[tuple[int, int]]:
        """(length, pieces) of the free pieces put into this space, the largest that fits first."""
        plan, largest = [], space
        while fits := lengths_mask & ((2 << largest) - 1):
            n = fits.bit_length() - 1
            plan.append((n, min(waiting[n], space // n)))
            space -= n * plan[-1][1]
            largest = min(space, n - 1)
        return plan

    for n in lengths:
        fitting = mask >> n
        if promised[n] and (fitting or not waiting[n]):
            promised[n] -= 1
        else:
            take(n, 1)
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                mask &= ~(1 << r)
        else:
            plans = {c: foreseen(c - n) for c in capacities if c >= n}
            size = min(plans, key=lambda c: (costs[c] / (n + sum(m * k for m, k in plans[c])), c))
            for m, k in plans[size]:
                take(m, k)
                promised[m] += k
            b = len(used)
            used.append(0)
            room.append(size)
        placed.append((b, used[b]))
        used[b] += n
        r = room[b] - used[b]
        if r:
            free.setdefault(r, []).append(b)
            mask |= 1 << r
    return placed, [(u, next(c for c in capacities if c >= u)) for u in used]


def count_tokens(docs: DataFrame, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """The rows of ``docs`` without ``text``, plus the number of words of the whole text and one for its end."""
    import pyarrow as pa

    rest = [c for c in docs.columns if c not in (text, out)]
    schema = docs.select(*rest).schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(len(rest)))
            n = np.ones(len(offsets) - 1, "i8")
            for first, last in slices(offsets):  # a megabyte of whole texts at a time
                o = offsets[first : last + 1]
                inside = ~IS_SPACE[data[o[0] : o[-1]]]
                o = o - o[0]
                begins = inside.copy()
                begins[1:] &= ~inside[:-1]
                edges = o[:-1][np.diff(o) > 0]
                begins[edges] = inside[edges]
                words = np.add.reduceat(begins, edges, dtype="i8") if len(edges) else 0
                n[first:last][np.diff(o) > 0] += words
            cols = [batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64())], names=[*rest, out])

    return docs.select(*rest, text).mapInArrow(run, schema)


def pack_lengths(
    rows: DataFrame,
    key: str,
    length: str | Column,
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
    attention: int = ATTENTION,
) -> DataFrame:
    """(key, piece, n_tokens, bin_id, start, capacity, bin_used): where each row goes.

    A row longer than the largest capacity is cut into pieces of that capacity and a rest; nothing is dropped. Rows whose
    length is null or not positive take no place: one piece 0 of 0 tokens with null bin. Equal rows are placed each; ties
    in length are packed in order of the key. An empty table gives an empty result. Other columns are left out.
    """
    import pandas as pd

    most = max(capacities)
    n = (F.col(length) if isinstance(length, str) else length).cast("long")
    rows = materialise(rows.select(F.col(key).alias("key"), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).alias("n")))
    pieces = rows.select(
        "key", "n", F.posexplode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most), F.lit(1)) - 1)).alias("piece", "_")
    )
    pieces = pieces.select("key", "piece", F.least(F.lit(most), F.col("n") - F.col("piece") * most).alias("n_tokens"))
    total = rows.agg(F.coalesce(F.sum(F.greatest(F.ceil(F.col("n") / most), F.lit(1))), F.lit(0))).first()[0]
    shards = int(total // SHARD_PIECES) + 1
    # the row's place in the written table salts keys that many rows share
    shard = F.pmod(F.xxhash64("key", "piece", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    capacities = tuple(capacities)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", "key", "piece"], ascending=[False, True, True], kind="stable")
        real = part["n_tokens"].to_numpy() > 0
        placed, bins = pack(part["n_tokens"].to_numpy()[real].tolist(), capacities, overhead, attention)
        out = part[["key", "piece", "n_tokens"]].copy()
        shard = int(part["shard"].iloc[0])
        for name in ("bin_id", "start", "capacity", "bin_used"):
            out[name] = pd.array([pd.NA] * len(out), dtype="Int64")
        out.loc[real, "bin_id"] = [(shard << 32) + b for b, _ in placed]
        out.loc[real, "start"] = [s for _, s in placed]
        out.loc[real, "capacity"] = [bins[b][1] for b, _ in placed]
        out.loc[real, "bin_used"] = [bins[b][0] for b, _ in placed]
        return out

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, n_tokens long, bin_id long, start long, capacity long, bin_used long"
    out = pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(run, schema)
    return out.withColumnRenamed("key", key)
