"""Cases of the fourth round's findings: plain texts pass long patterns, shuffles end with their table, pairs and vectors travel packed."""

import random
import re
import unicodedata

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.functions import text as T
from quarrymill.operators import corpus as C, lookups, textscore as X, windows, wordvec
from quarrymill.plans import session

V_ORIGINAL = wordvec.word_vectors


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_pattern_sees_no_plain_characters(spark):
    rng = random.Random(1)
    rows = ["".join(rng.choices("aé.!? \x00\x7f\n\tß字한がй́😀Z[`{@-", k=rng.randint(0, 12))) for _ in range(500)] + ["", None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")

    def want(t):
        bare = re.sub(T.MARKS, "", unicodedata.normalize("NFD", t))
        return re.sub("[^a-zA-Z.!?]+", " ", re.sub("([.!?])", r" \1", bare))

    got = df.select("t", T._letters_only(T.strip_marks("t")).alias("s")).collect()
    assert all(x.s == (None if x.t is None else want(x.t)) for x in got)
    more, plain = T._bare_letters()[2:]
    seen = df.select(F.regexp_replace("t", plain + "+", "").alias("left")).filter("t IS NOT NULL").collect()
    assert set("".join(x.left for x in seen)) <= set("한が́")
    assert not re.search("RLIKE\\(lower\\(|RLIKE\\(t#", _plan(df.select(T.strip_marks("t"))).replace(more, ""))


def test_shuffles_end_with_the_table_and_stale_tables_are_deleted(spark, tmp_path):
    from pathlib import Path



    cleanup = spark.conf.get(session.CLEANUP_CONF, "false")
    made = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    for _ in range(3):
        session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    # those of other tests may go in the meantime
    assert tracker.shuffleStatuses().size() <= before
    assert spark.conf.get(session.CLEANUP_CONF, "false") == cleanup
    path = Path(made._written.removeprefix("file:"))
    assert made.count() == 7 and path.exists()
    session.discard(made)
    assert not path.exists()


def test_packs_hold_some_four_bytes_a_pair():
    rng = np.random.default_rng(3)
    keys = np.unique((rng.integers(0, 1000, 20_000) << 32) | rng.integers(0, 200_000, 20_000))
    sums = rng.choice([1 / g for g in range(1, 16)], len(keys))
    packed = windows.pack(keys, sums)
    assert len(packed) < 5 * len(keys)
    for k, s in ((keys, sums), (keys, rng.normal(size=len(keys))), (keys[:0], sums[:0]), (np.array([5, 5, 2**62]), np.array([1.0, 2.0, 3.0]))):
        back = windows.unpack(windows.pack(k, s))
        assert back[0].tolist() == k.tolist() and back[1].tolist() == s.tolist()
    many = np.arange(70_000)
    back = windows.unpack(windows.pack(many, many / 3))
    assert (back[0] == many).all() and (back[1] == many / 3).all()


def test_pairs_of_a_frequent_word_are_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(windows, "BUCKET_PAIRS", 50)
    lists = [[1, i] * 3 for i in range(2, 80)]
    df = spark.createDataFrame([(x,) for x in lists], "w array<int>")
    counts = spark.createDataFrame([(1, 3 * 78)], "word long, n long")
    want = {}
    for x in lists:
        for i, a in enumerate(x):
            for gap, b in enumerate(x[i + 1 : i + 3], 1):
                want[min(a, b), max(a, b)] = want.get((min(a, b), max(a, b)), 0) + 1 / gap
    got = windows.window_pairs(df, "w", [1.0, 0.5], counts).withColumn("p", F.spark_partition_id()).collect()
    assert {(x.a, x.b): x.weight for x in got} == pytest.approx(want) and len(got) == len(want)
    deal = windows._dealer(64, {1: 20})
    assert len(set(deal((np.int64(1) << 32) | np.arange(100)).tolist())) > 8
    assert len(set(deal((np.int64(2) << 32) | np.arange(100)).tolist())) == 1


def test_pairs_are_dealt_as_spark_hashes_them(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2**31), rng.randrange(2**31)) for _ in range(50)] + [(0, 0)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    a, b = (np.array([x[c] for x in got], "i8") for c in ("a", "b"))
    assert wordvec.pair_hash(a, b).tolist() == [x.h for x in got]


@pytest.mark.parametrize("way", ["small", "large"])
def test_cooccurrence_by_numbers_has_the_named_pairs(spark, request, way):
    if way == "large":
        request.getfixturevalue("big")
    df = spark.createDataFrame([(1, "a b a zz"), (2, "c b"), (2, "b a"), (None, "a b"), (None, "c"), (3, None), (5, "a c c b a b")], "k long, t string")
    named = C.cooccurrence(df, "k", T.tokens("t"), 3, 2)
    vocab, pairs = C.cooccurrence(df, "k", T.tokens("t"), 3, 2, named=False)
    word = {x.word: x.token for x in vocab.collect()}
    want = {(x.a, x.b): x.weight for x in named.collect()}
    assert {(word[x.a], word[x.b]): x.weight for x in pairs.collect()} == pytest.approx(want)
    assert "zz" not in word.values() and len(want) == 6


@pytest.mark.parametrize("block", [32 << 20, 60])
def test_vectors_travel_once_a_block(spark, monkeypatch, block):
    monkeypatch.setattr(lookups, "BLOCK_BYTES", block)
    rng = np.random.default_rng(2)
    vectors = {w: rng.normal(size=4) for w in "abcde"}
    mean = np.mean(list(vectors.values()), axis=0)
    table = spark.createDataFrame([(w, x.tolist()) for w, x in vectors.items()], "token string, vector array<double>")
    rows = [(1, "a b b", ["a zz", ""]), (2, "c", ["b a"]), (2, "d d", ["e", "a"]), (None, "a", ["b"]), (3, None, ["a"]), (4, "a", None), (5, "zz", ["yy a"]), (6, "a", ["", None, "b"])]
    found = X.token_vectors(spark.createDataFrame(rows, "id long, hyp string, refs array<string>"), table)
    assert found.filter("__kind = 1").groupBy("__block", "token").count().filter("count > 1").count() == 0
    merged = {1: ("a b b", ["a zz"]), 2: ("c d d", ["b a e", "a"]), 5: ("zz", ["yy a"]), 6: ("a", ["b"])}
    vec = lambda t: np.array([vectors.get(w, mean) for w in t.split()])
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    want = {k: max(cos(vec(h).sum(0), vec(r).sum(0)) for r in refs) for k, (h, refs) in merged.items()}
    assert {x.id: x.emb_average for x in X.emb_average(found).collect()} == pytest.approx(want)
    assert {x.id for x in X.emb_greedy(found).collect()} == {x.id for x in X.emb_extrema(found).collect()} == set(want)


def test_vectors_of_the_scores_are_trained_in_all_rounds(monkeypatch):
    import inspect

    from quarrymill.catalog import q_textscore

    asked = {}
    monkeypatch.setattr(wordvec, "word_vectors", lambda *a, **how: asked.update(how))
    for name in ("load", "pairs"):
        monkeypatch.setattr(q_textscore, name, lambda *a: None)
    monkeypatch.setattr(q_textscore.X, "token_vectors", lambda *a: None)
    monkeypatch.setattr(q_textscore.T, "tokens", lambda c: None)
    q_textscore._token_vectors(None, None)
    rounds = inspect.signature(V_ORIGINAL).parameters["rounds"].default
    assert asked.get("rounds", rounds) >= 15


def test_joined_texts_are_looked_up_alike(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BLOCK_BYTES", 9)
    rows = [(1, ["a", "b b", "c"]), (2, []), (3, None), (4, ["c"]), (5, ["zz", "a"])]
    df = session.materialise(spark.createDataFrame(rows, "k long, e array<string>").repartition(2))
    table = session.materialise(spark.createDataFrame([("a", 1.5), ("b b", 2.5), ("c", 3.5)], "entry string, v double"))
    value = {"a": 1.5, "b b": 2.5, "c": 3.5}
    for joiner in (None, "\t"):
        found = lookups.look_up(df, "e", table, "v", "f", F.xxhash64("k"), joiner)
        assert {x.k: x.e for x in found.collect()} == dict(rows)
        assert {x.k: x.f or [] for x in found.collect()} == {k: [value.get(t) for t in e or []] for k, e in rows}
