"""One-row aggregates used inside row expressions, as scalar subqueries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class Scalars:
    """Named aggregates of one frame; ``s["name"]`` is a column usable in any select over other frames.

    All names share one aggregate, so the plan holds one subquery that Spark runs once.
    """

    def __init__(self, df: DataFrame, **aggs: Column):
        fields = [agg.alias(name) for name, agg in aggs.items()]
        self._one = df.agg(F.struct(*fields).alias("scalars"))

    def __getitem__(self, name: str) -> Column:
        return self._one.scalar().getField(name)
