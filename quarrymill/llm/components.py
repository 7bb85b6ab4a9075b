"""Connected components of a table of links, by alternating large-star and small-star rounds.

Every round is two joins and aggregates over the links; the rounds' tables are written to the shared folder, so a lost
executor costs one step. The number of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.session import materialise


def _signature(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of a link (columns ``a`` and ``b``): the smallest node reachable. Repeated links, both
    directions and loops are allowed; null ends are passed over; no links give no rows."""
    now = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(now)
    before = _signature(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        after = _signature(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
