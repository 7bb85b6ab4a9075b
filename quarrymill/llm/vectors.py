"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(key, v, norm): rows with a key whose vector is not null, not empty, not zero and has finite components only; components in
    double precision. Vectors of a length other than the most common one take no part either."""
    v = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), v.alias("v")).filter("key IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(fine & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return rows.withColumn("norm", F.lit(0.0))
    rows = rows.filter(F.size("v") == usual["d"])
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column, or of a pandas column of arrays, as a matrix of doubles."""
    import pyarrow as pa

    if isinstance(column, (pa.ListArray, pa.LargeListArray)):
        flat = column.flatten().to_numpy(zero_copy_only=False).astype("f8")
        return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    return np.array(column.tolist(), "f8") if len(column) else np.zeros((0, 0))
