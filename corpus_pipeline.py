"""Corpus pipeline: quality, repeated lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of ``documents``; the
last returns the packing. ``run`` writes every stage's rows as Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarrymill.llm.exprs import crc_mod
from quarrymill.llm.jaccard_join import near_duplicates
from quarrymill.llm.line_dedup import dedup_lines
from quarrymill.llm.packing import count_tokens, pack_lengths
from quarrymill.llm.quality_pu import accepted
from quarrymill.plans.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from those whose crc32(doc_id) mod 3 is not 1. Each row is
    judged by its own text, empty and null texts, rows without an id and repeated rows included."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return accepted(docs, labels, crc_mod(F.col("doc_id"), 3) != 1, COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share; ``n_chars`` follows the text. Documents that keep no text
    stay, as empty ones."""
    out = dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Documents without words are no copies; rows
    without an id, and rows that repeat an id, stay."""
    surplus = near_duplicates(docs).filter("doc_id <> component_id").select("doc_id")
    return docs.join(surplus, "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: (doc_id, piece, n_tokens, bin_id, start, capacity, bin_used)."""
    return pack_lengths(count_tokens(docs.select("doc_id", "text")), "doc_id", "n_tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", packing),
]

#: The classifier and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
