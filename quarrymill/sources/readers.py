"""Scans: delimited text, columnar files, nested JSON, paired lines and sparse text rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.ordering import row_numbers

COLUMNAR = {".parquet": "parquet", ".orc": "orc", ".json": "json"}
REJECTED = {".h5", ".hdf5", ".xlsx", ".xls"}


def strip_bom(df: DataFrame) -> DataFrame:
    """Remove a byte-order mark that a header line carried into a column name."""
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def _delimited(spark, path, sep, schema, cols, limit, header, timestamp_format) -> DataFrame:
    reader = spark.read.option("header", header).option("sep", sep)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    df = strip_bom((reader.schema(schema) if schema is not None else reader).csv(path))
    if cols:
        df = df.select(*cols)
    return df.limit(limit) if limit else df


def read_csv(spark, path, schema=None, cols=None, limit=None, header=True, timestamp_format=None) -> DataFrame:
    """Comma-separated scan with a given schema, column projection and an optional row cap."""
    return _delimited(spark, path, ",", schema, cols, limit, header, timestamp_format)


def read_tsv(spark, path, schema=None, cols=None, limit=None, header=True, timestamp_format=None) -> DataFrame:
    """Tab-separated scan; the path may be a glob over part files."""
    return _delimited(spark, path, "\t", schema, cols, limit, header, timestamp_format)


def read_parquet(spark: SparkSession, path: str, cols: Sequence[str] | None = None, limit: int | None = None):
    df = spark.read.parquet(path)
    df = df.select(*cols) if cols else df
    return df.limit(limit) if limit else df


def read_frame(spark: SparkSession, path: str, limit: int | None = None, schema=None) -> DataFrame:
    """Scan by file extension; anything that is not a known columnar format is read as CSV."""
    lowered = path.rstrip("/").lower()
    for ending in REJECTED:
        if lowered.endswith(ending):
            raise ValueError(f"{ending} files cannot be split over executors; convert them to Parquet first")
    for ending, fmt in COLUMNAR.items():
        if lowered.endswith(ending):
            reader = spark.read.schema(schema) if schema is not None else spark.read
            df = reader.format(fmt).load(path)
            return df.limit(limit) if limit else df
    if lowered.endswith((".tsv", ".txt")):
        return read_tsv(spark, path, schema, limit=limit)
    return read_csv(spark, path, schema, limit=limit)


ANNOTATION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField(
            "annotations",
            T.ArrayType(T.StructType([T.StructField("Q", T.StringType()), T.StructField("A", T.StringType())])),
        ),
        T.StructField("source", T.StringType()),
    ]
)


def explode_annotations(df: DataFrame) -> DataFrame:
    """One row per question and answer of a nested document."""
    return df.select("id", "text", "source", F.posexplode("annotations").alias("pos", "qa")).select(
        "id", "source", "text", "pos", F.col("qa.Q").alias("question"), F.col("qa.A").alias("answer")
    )


def read_annotations(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Nested JSON documents, one record per line or (``multi_line``) one array per file."""
    raw = spark.read.schema(ANNOTATION_SCHEMA).option("multiLine", multi_line).json(path)
    return explode_annotations(raw)


def pair_lines(df: DataFrame, key: str, text: str, period: int = 2, keep: Sequence[int] = (0, 1)) -> DataFrame:
    """Lines of each text, blank ones removed, taken in groups of ``period``; the kept places become columns.

    Everything happens inside one row, so no shuffle is needed. A last group that is not full is dropped.
    """
    lines = F.filter(F.split(F.col(text), "\r?\n"), lambda x: F.trim(x) != "")
    starts = F.when(
        F.floor(F.size("__lines") / period) > 0,
        F.sequence(F.lit(0), (F.floor(F.size("__lines") / period) - 1).cast("int")),
    ).otherwise(F.array().cast("array<int>"))
    def pick(pair: Column) -> Column:
        parts = [F.element_at(F.col("__lines"), pair * period + (k + 1)).alias(f"part{k}") for k in keep]
        return F.struct(pair.alias("pair"), *parts)

    rows = df.select(F.col(key), lines.alias("__lines"))
    return rows.select(key, F.explode(F.transform(starts, pick)).alias("p")).select(key, "p.*")


def number_lines(spark: SparkSession, path: str, name: str = "line") -> DataFrame:
    """Text lines with their 1-based number, in file order, whatever way the file was split."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
        "value",
    )
    return row_numbers(raw, ["__file", "__block", "__at"], name=name).select(name, "value")


def parse_libsvm(line: Column) -> list[Column]:
    """Label and sparse entries of one ``label idx:val ...`` line."""
    parts = F.split(line, " ")
    entries = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.struct(
            F.split(p, ":")[0].cast("int").alias("idx"), F.split(p, ":")[1].cast("double").alias("val")
        ),
    )
    return [parts[0].cast("double").alias("label"), entries.alias("entries")]


def read_libsvm(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """Sparse text rows to ``label`` and ``entries``; with ``dim`` an index outside the width is refused."""
    df = spark.read.text(path).filter(F.trim("value") != "").select(*parse_libsvm(F.trim("value")))
    if dim is not None:
        bad = F.exists("entries", lambda e: (e["idx"] < 0) | (e["idx"] >= dim))
        df = df.withColumn("entries", F.when(bad, F.raise_error(F.lit(f"index outside width {dim}"))).otherwise(F.col("entries")))
    return df
