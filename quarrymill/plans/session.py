"""Session defaults, the shared scratch folder, lineage cuts and sizes."""

from __future__ import annotations

from contextlib import contextmanager
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Whether the files of a query's shuffles are deleted when it ends; a frame that is run again makes them again.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "quarrymill", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks; a cluster supplies its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names, or a temporary one in local mode only."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="quarrymill-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _width(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(column), F.lit(0)) * 16 + 16
    return F.lit(16)


def size_metrics(df: DataFrame) -> list:
    """Aggregates for the number of rows and about how many bytes they take in memory."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0)).cast("long")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


@contextmanager
def _shuffles_end(spark: SparkSession):
    """What is run within leaves no shuffle files, which otherwise stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder once and read them back, so that a lost executor cannot
    change what later steps see. The shuffles behind them are over with that."""
    path = scratch_path(df.sparkSession, "table")
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more: what was made of them is written, too."""
    for df in written:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write a frame that is about to be read several times, unless it comes straight from ``materialise``."""
    return df if getattr(df, "_written", False) else materialise(df)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a frame, counted once per frame object."""
    known = getattr(df, "_measured", None)
    if known is None:
        found = df.agg(*size_metrics(df)).first()
        known = df._measured = (found["rows"], found["bytes"])
    return known


def tables(spark: SparkSession, folder: str, *names: str):
    """Parquet tables of a folder by name."""
    frames = [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]
    return frames[0] if len(frames) == 1 else frames
