"""Exact ranks, running sums and quantiles without a window over a whole group.

The rows are first reduced to distinct (group, value) pairs. Those are range-partitioned by (group, value), which
splits a large group over many partitions; each partition keeps a local running sum and receives the total of the
partitions before it. The range-partitioned table is written because the partition number becomes data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .session import materialise
from .skew import is_small, salted_join


def running_sums(
    df: DataFrame, order: Sequence[Column | str], measures: Sequence[str], keys: Sequence[str] = (), totals: bool = True
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive, in ``order`` within ``keys``) and ``tot_<m>``; ``order`` must be unique per group."""
    keys = list(keys)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    slotted = materialise(
        df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("__slot", F.spark_partition_id())
    )
    sums = slotted.groupBy(*keys, "__slot").agg(*[F.sum(m).alias(f"__s_{m}") for m in measures])
    # one row per partition and group: never more than the number of partitions for one group
    before = W.partitionBy(*keys).orderBy("__slot").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = sums.select(
        *keys,
        "__slot",
        *[F.coalesce(F.sum(f"__s_{m}").over(before), F.lit(0)).alias(f"__o_{m}") for m in measures],
        *([F.sum(f"__s_{m}").over(whole).alias(f"tot_{m}") for m in measures] if totals else []),
    )
    local = W.partitionBy(*keys, "__slot").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = slotted.select("*", *[F.sum(m).over(local).alias(f"__c_{m}") for m in measures])
    # null keys form a group of their own, so the match is null-safe
    offsets = offsets.withColumnsRenamed({k: f"__k_{i}" for i, k in enumerate(keys)} | {"__slot": "__from"})
    match = F.col("__slot") == F.col("__from")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k_{i}"))
    out = inner.join(offsets, match)
    return out.select(
        *df.columns,
        *[(F.col(f"__c_{m}") + F.col(f"__o_{m}")).alias(f"cum_{m}") for m in measures],
        *([f"tot_{m}" for m in measures] if totals else []),
    )


def rank_table(df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Per distinct non-null value of a group: ``n``, ``rank_min``, ``rank_avg``, ``rank_dense``, ``total``."""
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull())
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    order = F.col(value).desc() if descending else F.col(value).asc()
    run = running_sums(counts, [order], ["n", "one"], keys)
    return run.select(
        *keys,
        value,
        "n",
        (F.col("cum_n") - F.col("n") + 1).alias("rank_min"),
        (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("rank_avg"),
        F.col("cum_one").alias("rank_dense"),
        F.col("cum_n").alias("rank_max"),
        F.col("tot_n").alias("total"),
    )


def attach_ranks(df, value, keys=(), columns=("rank_avg", "total"), descending=False, salt_on=None) -> DataFrame:
    """Ranks of ``value`` within ``keys`` on every row (null where the value is null)."""
    on = [*keys, value]
    table = rank_table(df, value, keys, descending)
    table = materialise(table)
    wanted = table.select(*on, *columns)
    if is_small(table):
        return df.join(F.broadcast(wanted), on, "left")
    return salted_join(df, wanted, on, "left", salt_on, table.select(*on, "n"))


def row_numbers(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = (), name: str = "row_number"):
    """Exact 1-based row number, balanced for any group size. Rows that are equal in the whole order get different numbers in
    no particular order, so the order should be unique or such rows interchangeable."""
    run = running_sums(df.withColumn("__one", F.lit(1)), order, ["__one"], keys, totals=False)
    return run.withColumnRenamed("cum___one", name).drop("__one")


def group_quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation; one row per group with a column per entry of ``probs``."""
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull())
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return quantiles_from_counts(running_sums(counts, [value], ["n"], keys), value, probs, keys)


def quantiles_from_counts(run: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Quantiles from a running table with ``n``, ``cum_n`` and ``tot_n`` per value."""
    aggs = [F.max("tot_n").alias("__n")]
    for i, q in enumerate(probs.values()):
        spot = F.lit(float(q)) * (F.col("tot_n") - 1)
        for side, at in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            aggs.append(F.min(F.when(F.col("cum_n") > at, F.col(value))).cast("double").alias(f"__{side}{i}"))
    out = run.groupBy(*keys).agg(*aggs)
    cols = []
    for i, (name, q) in enumerate(probs.items()):
        spot = F.lit(float(q)) * (F.col("__n") - 1)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        cols.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(name))
    return out.select(*keys, *cols)
