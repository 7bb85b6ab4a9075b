"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n, keeper): the 128-bit hash of a line's key, how many documents of a batch hold it, and the
document that keeps the line. Runs are sorted by hash inside their files. A new batch is reduced to its own run, anti-joined
with the live runs to tell fresh keys from known ones, and added on level 0; ``fanout`` runs of a level are compacted into one
run of the next level. Batches come in descending order of ``doc_id``, so the first batch with a key names its keeper and
later batches only add to the count.

Only DataFrame functions are used: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.session import scratch_path
from .exprs import SPACE, lower_ascii

HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


class LineRuns:
    """Levels of sorted runs in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _write(self, run: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "line-run")
        run.sortWithinPartitions(*HASHES).write.parquet(path)
        return self.spark.read.schema(run.schema).parquet(path)

    def live(self) -> DataFrame | None:
        """All runs in one frame; a key may stand in several."""
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    @staticmethod
    def merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*HASHES).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def add(self, entries: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, h1, h2), one row per document and key; returns the batch's run, where ``keeper`` is
        null for keys that an earlier batch already holds."""
        run = entries.groupBy(*HASHES).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        known = self.live()
        if known is not None:
            fresh = run.join(known.filter("keeper IS NOT NULL").select(*HASHES), HASHES, "left_anti").select(
                *HASHES, F.col("keeper").alias("mine")
            )
            run = run.drop("keeper").join(fresh, HASHES, "left").withColumnRenamed("mine", "keeper")
        run = self._write(run.select(*HASHES, "n", "keeper"))
        self.levels[0].append(run)
        self._compact()
        return run

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            together = self.levels[level][0]
            for run in self.levels[level][1:]:
                together = together.unionByName(run)
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self.merged(together)))
            level += 1

    def totals(self) -> DataFrame:
        runs = self.live()
        return self.merged(runs) if sum(map(len, self.levels)) > 1 else runs


def _entries(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2): the distinct long keys of each row. A key of ``min_chars`` code points has as many bytes at least,
    so short lines are passed over before they are normalised."""
    long = F.filter(_lines(F.col("text")), lambda x: F.octet_length(x) >= min_chars)
    keys = F.filter(F.transform(long, line_key), lambda k: F.char_length(k) >= min_chars)
    one = docs.select("doc_id", F.explode(F.array_distinct(F.transform(keys, _hash))).alias("h"))
    return one.select("doc_id", "h.h1", "h.h2")


def frequent_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int, fanout: int):
    """(entries, keys held by at least ``min_docs`` rows with their keeper)."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] or []
    batch = sum((F.when(F.col("doc_id") <= c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    path = scratch_path(spark, "line-entries")
    _entries(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    entries = spark.read.schema("doc_id long, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for i in range(len(set(cuts)) + 1):  # rows without an id fall into batch 0
        runs.add(entries.filter(F.col("batch") == i).drop("batch"))
    found = scratch_path(spark, "line-frequent")
    runs.totals().filter(F.col("n") >= min_docs).write.parquet(found)
    return entries.drop("batch"), spark.read.schema("h1 long, h2 long, n long, keeper long").parquet(found)


def _doomed(entries: DataFrame, frequent: DataFrame, share: float = 1 / 2000) -> DataFrame:
    """(doc_id, drop): the hashes that a document loses. Keys above the share of all entries number at most ``1 / share``
    and are looked up by broadcast, so none of them gathers in one task; the others are joined."""
    total = frequent.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    floor = max(1000, int(total * share))
    hot = frequent.filter(F.col("n") >= floor).select(*HASHES, F.col("keeper").alias("hot_keeper"))
    rest = frequent.filter(F.col("n") < floor).select(*HASHES, "keeper")
    marked = entries.join(F.broadcast(hot), HASHES, "left")
    by_hot = marked.filter("hot_keeper IS NOT NULL").select("doc_id", *HASHES, F.col("hot_keeper").alias("keeper"))
    by_rest = marked.filter("hot_keeper IS NULL").select("doc_id", *HASHES).join(rest, HASHES)
    losing = by_hot.unionByName(by_rest.select("doc_id", *HASHES, "keeper")).filter(F.col("doc_id") < F.col("keeper"))
    return losing.groupBy("doc_id").agg(F.collect_set(F.struct(*HASHES)).alias("__drop"))


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 4
) -> DataFrame:
    """The rows of ``docs`` with ``text`` freed of frequent lines, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. A key of at least ``min_chars`` code points
    found in at least ``min_docs`` rows loses all its lines except in the row with the largest ``doc_id`` holding it.

    Null and empty texts are one empty line and stay as they are. Rows sharing a ``doc_id`` count as documents of their own
    and are treated alike; rows without a ``doc_id`` are counted but keep all lines. An empty table gives an empty result.
    Other columns pass through; columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    entries, frequent = frequent_lines(docs.select("doc_id", "text"), min_chars, min_docs, batches, fanout)
    rows = docs.drop("n_lines", "n_dropped").join(_doomed(entries, frequent), "doc_id", "left")
    lines = _lines(F.col("text"))
    kept = F.filter(
        lines,
        lambda x: ~((F.octet_length(x) >= min_chars) & F.array_contains(F.col("__drop"), _hash(line_key(x)))),
    )
    rows = rows.withColumn("__kept", F.when(F.col("__drop").isNotNull(), kept))
    hit = F.col("__kept").isNotNull()
    return rows.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.when(hit, F.size(lines) - F.size("__kept")).otherwise(0).cast("long"),
        "text": F.when(hit, F.concat_ws("\n", "__kept")).otherwise(F.col("text")),
    }).drop("__drop", "__kept")
