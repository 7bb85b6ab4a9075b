"""The ways for large tables give the same rows as the ways for small ones, also with one hot key."""

import random

from pyspark.sql import Window as W, functions as F
import pytest

from quarrymill.plans.ordering import attach_ranks, group_quantiles, rank_table, row_numbers, running_sums
from quarrymill.plans.scalars import Scalars
from quarrymill.plans.skew import attach_groups, hot_keys, lookup_join, salted_join


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", float(rng.randrange(200)), rng.random()) for i in range(3000)]
    return spark.createDataFrame(data, "id long, k string, v double, u double").cache()


def as_set(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_running_sums_split_groups(rows, big):
    counts = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("k").orderBy("v")
    want = counts.select("k", "v", "n", F.sum("n").over(w).alias("cum_n"), F.sum("n").over(W.partitionBy("k")).alias("tot_n"))
    got = running_sums(counts.repartition(6), [F.col("v")], ["n"], ["k"])
    assert as_set(got) == as_set(want)


def test_running_sums_uses_many_partitions(spark, rows, big):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = row_numbers(rows.select("id", "u"), ["u", "id"], name="i")
        want = rows.select("id", "u", F.row_number().over(W.orderBy("u", "id")).cast("long").alias("i"))
        assert as_set(got) == as_set(want)
        got = row_numbers(rows.select("id", "k", "u"), [F.col("u").desc(), "id"], ["k"], name="i")
        want = rows.select("id", "k", "u", F.row_number().over(W.partitionBy("k").orderBy(F.col("u").desc(), "id")).alias("i"))
        assert as_set(got) == as_set(want)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quantiles_match_percentile(rows, big):
    got = group_quantiles(rows, "v", {"a": 0.01, "b": 0.5, "c": 0.99}, ["k"])
    want = rows.groupBy("k").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in (("a", 0.01), ("b", 0.5), ("c", 0.99))])
    assert as_set(got) == as_set(want)


def test_row_numbers_keep_null_groups(spark, big):
    df = spark.createDataFrame([(i, None if i < 4 else "a") for i in range(9)], "id long, k string")
    got = row_numbers(df, ["id"], ["k"], name="i")
    assert sorted((r["id"], r["i"]) for r in got.collect()) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 1), (5, 2), (6, 3), (7, 4), (8, 5)]


def test_quantiles_skip_nulls_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), (None, 9.0)], "k string, v double")
    assert as_set(group_quantiles(df, "v", {"m": 0.5}, ["k"])) == [("a", 2.5)]


def test_ranks(rows, big):
    got = attach_ranks(rows, "v", ["k"], ("rank_min", "rank_avg", "rank_dense", "total"), salt_on=["id"]).select("id", "rank_min", "rank_avg", "rank_dense", "total")
    w = W.partitionBy("k").orderBy("v")
    same = F.count(F.lit(1)).over(W.partitionBy("k", "v"))
    want = rows.select("id", F.rank().over(w).alias("a"), (F.rank().over(w) + (same - 1) / 2).alias("b"), F.dense_rank().over(w).alias("c"), F.count(F.lit(1)).over(W.partitionBy("k")).alias("d"))
    assert as_set(got) == as_set(want)
    assert rank_table(rows, "v").count() == rows.select("v").distinct().count()


def test_salted_join_keeps_every_row(rows):
    table = rows.groupBy("k").agg(F.avg("v").alias("m")).filter("k <> 'k7'")
    got = salted_join(rows, table, ["k"], salt_on=["id"]).select("id", "m")
    want = rows.join(table, "k", "left").select("id", "m")
    assert as_set(got) == as_set(want)


def test_salted_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id long, k string")
    right = spark.createDataFrame([("a", 1)], "k string, x int")
    got = salted_join(left, right, ["k"], salt_on=["id"])
    assert got.count() == 40 and got.filter("x = 1").count() == 20


def test_hot_key_is_spread(rows):
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = {r["k"]: r["__salts"] for r in hot_keys(counts, ["k"], share=0.05).collect()}
    assert list(hot) == ["hot"] and hot["hot"] >= 7


def test_lookup_and_groups_agree(rows, big):
    want = rows.select("id", F.avg("v").over(W.partitionBy("k")).alias("m"))
    assert as_set(attach_groups(rows, ["k"], salt_on=["id"], m=F.avg("v")).select("id", "m")) == as_set(want)
    table = rows.groupBy("k").agg(F.avg("v").alias("m"))
    assert as_set(lookup_join(rows, table, ["k"], salt_on=["id"]).select("id", "m")) == as_set(want)


def test_scalars(rows):
    s = Scalars(rows, lo=F.min("v"), hi=F.max("v"))
    row = rows.select((s["hi"] - s["lo"]).alias("x")).distinct().collect()
    assert len(row) == 1 and row[0]["x"] == 199.0
