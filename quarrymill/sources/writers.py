"""Sinks: tables, delimited results, sparse text rows and feature index files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.session import scratch_path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table under the shared folder and read it back."""
    return df.sparkSession.read.parquet(write_parquet(df, scratch_path(df.sparkSession, name)))


def assert_same_columns(df: DataFrame, sample: DataFrame) -> DataFrame:
    """Refuse a result whose columns differ from a sample submission."""
    if df.columns != sample.columns:
        raise ValueError(f"columns {df.columns} differ from the sample's {sample.columns}")
    return df


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, single: bool = False) -> str:
    """CSV or TSV result. Part files by default; ``single`` asks for one file and suits small results only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("sep", sep).option("header", header).csv(path)
    return path


def write_submission(df: DataFrame, path: str, sample: DataFrame | None = None, sep: str = ",", single: bool = False):
    return write_delimited(df if sample is None else assert_same_columns(df, sample), path, sep, single=single)


def persist_predictions(df: DataFrame, path: str, key: str, target: str, prediction: str) -> str:
    """Evaluation rows as (id, target, prediction)."""
    rows = df.select(F.col(key), F.col(target).alias("target"), F.col(prediction).alias("prediction"))
    return write_parquet(rows, path)


def libsvm_line(label: Column, entries: Column) -> Column:
    """``label idx:1 idx:1 ...`` from an index array, or ``idx:val`` from an array of (idx, val)."""
    return F.concat_ws(" ", F.concat(label.cast("string")), F.array_join(entries, " "))


def index_entries(indices: Column) -> Column:
    return F.transform(F.array_sort(indices), lambda i: F.concat(i.cast("string"), F.lit(":1")))


def write_libsvm(df: DataFrame, path: str, label: str, indices: str) -> str:
    """Text rows with one ``idx:1`` per index."""
    lines = df.select(libsvm_line(F.col(label), index_entries(F.col(indices))).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path


def save_index(index: DataFrame, path: str) -> str:
    """Feature index as ``column:value<TAB>index`` rows."""
    return write_delimited(index.select("feature", "idx"), path, sep="\t", header=False)


def load_index(spark, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema("feature string, idx long").csv(path)
