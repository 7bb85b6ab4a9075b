"""Equi-joins that stay balanced when one key holds a large share of the rows.

Two ways, chosen by a measured size:
* the lookup side is small (rows and bytes are checked): broadcast it, the fact side is not shuffled;
* otherwise: keys that hold more than ``HOT_SHARE`` of the fact rows are salted. There can be at most
  ``1 / HOT_SHARE`` such keys, so the list of them is the only thing that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .scalars import Scalars
from .session import materialise, measure

HOT_SHARE = 1 / 1000
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame) -> bool:
    """Whether a frame is within the broadcast limits, by counting its rows and bytes."""
    found = measure(df)
    return found[0] <= BROADCAST_ROWS and found[1] <= BROADCAST_BYTES


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str = "n", share: float = HOT_SHARE) -> DataFrame:
    """Keys above the share and how many salts each needs; at most ``1 / share`` rows."""
    total = Scalars(counts, total=F.sum(n))["total"]
    return counts.filter(F.col(n) > F.lit(share) * total).select(
        *keys, F.ceil(F.col(n) / (F.lit(share) * total)).cast("int").alias("__salts")
    )


def salted_join(left, right, keys, how="left", salt_on=None, counts=None, n="n") -> DataFrame:
    """Join where ``right`` is unique on ``keys``. ``salt_on`` names the row key of ``left`` that spreads a hot key;
    ``counts`` may pass ready counts per key of ``left`` (columns ``keys`` and ``n``)."""
    keys = list(keys)
    if counts is None:
        n = "__count"
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    hot = F.broadcast(materialise(hot_keys(counts, keys, n)).toDF(*[f"__hot_{k}" for k in keys], "__salts"))

    def salts(df):
        match = None
        for k in keys:
            part = df[k].eqNullSafe(hot[f"__hot_{k}"])
            match = part if match is None else match & part
        joined = df.join(hot, match, "left").drop(*[f"__hot_{k}" for k in keys])
        return joined.withColumn("__salts", F.coalesce("__salts", F.lit(1)))

    spread = F.xxhash64(*(salt_on or left.columns))
    cut_left = salts(left).withColumn("__salt", F.pmod(spread, F.col("__salts")).cast("int")).drop("__salts")
    cut_right = salts(right).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    return cut_left.join(cut_right, [*keys, "__salt"], how).drop("__salt")


def lookup_join(left, right, keys, how="left", salt_on=None, counts=None, n="n", ready=False) -> DataFrame:
    """Bring the columns of a lookup table (unique on ``keys``) to every row of ``left``."""
    table = right if ready else materialise(right)
    if is_small(table):
        return left.join(F.broadcast(table), list(keys), how)
    return salted_join(left, table, keys, how, salt_on, counts, n)


def attach_groups(df, keys, how="left", salt_on=None, **aggs) -> DataFrame:
    """Group aggregates joined back to the rows: the balanced form of a window over whole groups."""
    keys = list(keys)
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), *[agg.alias(name) for name, agg in aggs.items()]
    )
    groups = materialise(groups)
    if is_small(groups):
        return df.join(F.broadcast(groups.drop("__rows")), keys, how)
    counts = groups.select(*keys, F.col("__rows").alias("n"))
    return salted_join(df, groups.drop("__rows"), keys, how, salt_on, counts)
