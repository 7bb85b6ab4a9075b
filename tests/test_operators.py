"""Small frames for rules that the oracle queries do not reach, and invariants."""

import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.functions import binning, numeric, text
from quarrymill.operators import columns, corpus, encoding, models, neighbors, select, split, stats
from quarrymill.operators.aggregate import GroupStats, recipe
from quarrymill.operators.blend import blend
from quarrymill.operators.profile import corr_matrix
from quarrymill.operators.relational import join_validated
from quarrymill.sources import readers, writers


def values(df, c):
    return [r[c] for r in df.collect()]


def test_cut_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 10.0, 11.0)] + [(None,)], "x double")
    assert values(df.select(binning.cut("x", [0, 1, 10]).alias("b")), "b") == [None, None, "(0, 1]", "(0, 1]", "(1, 10]", None, None]
    assert values(df.select(binning.cut("x", [0, 1, 10], right=False).alias("b")), "b") == [None, "[0, 1)", "[0, 1)", "[1, 10)", None, None, None]
    assert values(df.select(binning.cut_code("x", [0, 1, 10], include_lowest=True).alias("b")), "b") == [None, 0, 0, 0, 1, None, None]


def test_adjusted_skew_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("b", 9.0), ("c", 5.0), ("c", 5.0), ("c", 5.0)], "k string, v double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(numeric.adjusted_skew("v").alias("s")).collect()}
    assert got["a"] is None and got["c"] is None and got["b"] == pytest.approx(1.6300592)


def test_row_variance_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (None, None, None)], "a double, b double, c double")
    assert values(df.select(numeric.row_var(["a", "b", "c"]).alias("v")), "v") == [1.0, None]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert corr_matrix(df, ["a", "b"]).first()["corr"] is None


def test_headers_and_formats(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿user_id,x\n1,2\n", encoding="utf-8")
    df = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["user_id", "x"]
    with pytest.raises(ValueError):
        readers.read_frame(spark, "table.h5")
    with pytest.raises(ValueError):
        writers.assert_same_columns(df, df.select("x"))


def test_libsvm_width_is_checked(spark, tmp_path):
    (tmp_path / "x").write_text("1 0:1 7:0.5\n0\n")
    rows = readers.read_libsvm(spark, str(tmp_path / "x"), 8).orderBy("label").collect()
    assert rows[0]["entries"] == [] and rows[1]["entries"][1]["val"] == 0.5
    with pytest.raises(Exception, match="outside width"):
        readers.read_libsvm(spark, str(tmp_path / "x"), 7).collect()


def test_nested_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "text": "t", "annotations": [{"Q": "q1", "A": "a1"}, {"Q": "q2", "A": "a2"}], "source": "s"}]')
    rows = readers.read_annotations(spark, str(tmp_path / "a.json"), multi_line=True).collect()
    assert [(r["pos"], r["question"], r["answer"]) for r in rows] == [(0, "q1", "a1"), (1, "q2", "a2")]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 1.0)], "sr_a int, sr_b double, name string, bd_c double")
    assert columns.cols_like(df, "^sr_") == ["sr_a", "sr_b"]
    d = columns.variable_dictionary(df, {"name": "id"}, {"late": (3, 4)})
    assert d == {"sr_a": "sr", "sr_b": "sr", "name": "id", "bd_c": "late"}
    assert columns.select_features(df, categorical=["sr_a"]) == (["sr_b", "bd_c"], ["name", "sr_a"])
    with pytest.raises(ValueError):
        columns.select_features(df, numeric=["nope"])
    assert columns.split_by_max(df, ["sr_a", "sr_b"]) == (["sr_a"], ["sr_b"])
    twice = df.select("sr_a", "sr_b", F.lit(3).alias("sr_a"))
    assert columns.dedupe_columns(twice).columns == ["sr_a", "sr_b"]


def test_join_validation(spark):
    a = spark.createDataFrame([(1,), (1,)], "k int")
    b = spark.createDataFrame([(1, 2)], "j int, x int")
    with pytest.raises(ValueError):
        join_validated(a, b, "k", "j", "1:1")
    assert join_validated(a, b, "k", "j", "m:1").count() == 2


def test_one_hot_refuses_wide_columns(spark):
    with pytest.raises(ValueError):
        encoding.category_values(spark.range(50).withColumnRenamed("id", "c"), "c", 10)


def test_encoder_state_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    enc = encoding.OrdinalEncoder(["c"]).fit(df)
    enc.save(str(tmp_path))
    again = encoding.OrdinalEncoder(["c"]).load(spark, str(tmp_path))
    assert sorted(values(again.transform(df.unionByName(spark.createDataFrame([("z",)], "c string"))), "c")) == [0, 0, 1, 2]


def test_tags_keep_repeats_and_empty_rows(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, "x,y,a")], "id long, tags string")
    index = encoding.build_feature_index(df.filter("id < 3"), [], ["tags"])
    assert sorted(values(index, "feature")) == ["tags:a", "tags:b", "tags:others"]
    got = {r["id"]: r["indices"] for r in encoding.encode_rows(df, "id", index, [], ["tags"]).collect()}
    assert got == {1: [0, 1], 2: [], 3: [0, 2, 2]}


def test_group_stats_state(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0)], "k string, v double")
    rec = [recipe(["k"], [("v", "mean"), ("v", "count"), ("v", "median")])]
    GroupStats(rec).fit(df).save(str(tmp_path))
    out = GroupStats(rec).load(spark, str(tmp_path)).transform(df).orderBy("v").collect()
    assert out[0]["k_v_mean"] == 2.0 and out[0]["k_v_mean_neutral"] == pytest.approx(1 / 3) and out[2]["k_v_mean"] is None


def test_fold_invariants(spark):
    df = spark.range(200).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    sizes = split.add_fold(df, "id", 5, "y").groupBy("y", "fold").count().collect()
    assert sorted((r["y"], r["count"]) for r in sizes) == [(0, 30)] * 5 + [(1, 10)] * 5
    same = df.select("id", F.explode(F.array(F.lit(0), F.lit(1))).alias("fold"), (F.col("id") / 200 + 0.001).alias("p"))
    for method in ("mean", "gmean"):
        diff = blend(same, "id", "p", method).select(F.max(F.abs(F.col("prediction") - F.col("id") / 200 - 0.001)).alias("d"))
        assert diff.first()["d"] < 1e-12


def test_decode_inverts_encode(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "c c b")], "id long, t string")
    words = text.tokens("t")
    vocab = corpus.build_vocab(df, words, above=0, specials=corpus.SPECIALS)
    enc = corpus.encode_unk(df, "id", words, vocab, 8)
    assert {r["id"]: r["text"] for r in corpus.decode(enc, "id", "ids", vocab).collect()} == {1: "a b a c", 2: "c c b"}
    assert {r["id"]: r["length"] for r in enc.collect()} == {1: 5, 2: 4}


def test_long_text_way_agrees(spark, request):
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choice(["aa", "bb", "cc", "dd"]) for _ in range(40))) for i in range(20)], "id long, t string")
    args = dict(ngram_range=(1, 2), min_df=2, max_df=1.0, use_idf=True)
    small = {(r["id"], r["term"]): r["weight"] for r in corpus.tfidf(docs, "id", "t", **args).collect()}
    request.getfixturevalue("big")
    large = {(r["id"], r["term"]): r["weight"] for r in corpus.tfidf(docs, "id", "t", **args).collect()}
    assert small.keys() == large.keys() and all(abs(small[k] - large[k]) < 1e-12 for k in small)


def test_tag_answer_keeps_the_tail(spark):
    df = spark.createDataFrame([(1, "abcdefghij", "fg"), (2, "abcdefghij", "zz"), (3, "abc", "b")], "id long, t string, a string")
    rows = {r["id"]: r for r in corpus.tag_answer(df, ["id"], "t", "a", 6).collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["chars"] == ["<s>", "d", "e", "f", "g", "</s>"] and rows[1]["marks"] == [0, 0, 0, 1, 1, 0]
    assert rows[3]["chars"] == ["<s>", "a", "b", "c", "</s>", "<pad>"] and rows[3]["marks"] == [0, 0, 1, 0, 0, 0]


def brute_knn(q, b, k, self_match):
    out = {}
    for i, v in q.items():
        d = sorted((float(np.linalg.norm(np.array(v) - np.array(w))), j) for j, w in b.items() if not (self_match and i == j))
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("shard,run", [(7, 5), (40, 1000), (4096, 1000)])
def test_neighbors_are_exact(spark, monkeypatch, shard, run):
    """Clusters, copies, shards smaller than a cell and shards held by several tasks."""
    monkeypatch.setattr(neighbors, "SHARD_ROWS", shard)
    monkeypatch.setattr(neighbors, "QUERY_RUN", run)
    monkeypatch.setattr(neighbors, "CELLS", 200)
    rng = np.random.default_rng(0)
    points = {i: (rng.normal(size=3) + 6 * (i % 3)).tolist() for i in range(120)}
    points.update({200 + i: points[0] for i in range(30)})
    rows = [(i, v) for i, v in points.items()]
    df = spark.createDataFrame(rows + [(500, None), (None, points[1])], "id long, v array<double>")
    others = {i: points[i] for i in range(0, 230, 2) if i in points} | {300 + i: rng.normal(size=3).tolist() for i in range(5)}
    asked = spark.createDataFrame(list(others.items()), "id long, v array<double>")
    for queries, frame, alone in ((points, df, True), (others, asked, False)):
        got = {}
        for r in neighbors.knn(frame, df, "id", "v", 4, exclude_self=alone).orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append(r["neighbor"])
        assert got == brute_knn(queries, points, 4, alone)


def test_neighbors_move_few_rows(spark, monkeypatch):
    """Base rows reach one shard each; copies of one vector are one query and no more than k + 1 base rows."""
    monkeypatch.setattr(neighbors, "SHARD_ROWS", 50)
    seen = []
    search = neighbors._search
    monkeypatch.setattr(neighbors, "_search", lambda b, q, *a: seen.append((b.count(), q.count())) or search(b, q, *a))
    rng = np.random.default_rng(3)
    points = [(i, [float(i // 100) * 100 + rng.normal(), rng.normal()]) for i in range(400)] + [(1000 + i, [5.0, 5.0]) for i in range(300)]
    df = spark.createDataFrame(points, "id long, v array<double>")
    assert neighbors.knn(df, df, "id", "v", 3, exclude_self=True).count() == 3 * 700
    assert [b for b, _ in seen] == [404, 404]
    assert seen[0][1] == 401 and seen[1][1] < 401 * 3  # four far clusters of two shards each
    none = df.limit(0)
    assert neighbors.knn(df, none, "id", "v", 3).count() == 0 and neighbors.knn(none, df, "id", "v", 3).count() == 0


def test_smote_lies_between_neighbours(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=2).tolist(), int(i < 10)) for i in range(60)]
    df = spark.createDataFrame(data, "id long, v array<double>, y int")
    out = neighbors.smote(df, "id", "v", "y", 1, k=3, over=2.0, under=1.5).collect()
    made = [r for r in out if r["copy"] > 0]
    assert len(made) == 20 and sum(r["y"] == 0 for r in out) == 30
    low, high = np.min([v for _, v, y in data if y], axis=0), np.max([v for _, v, y in data if y], axis=0)
    assert all((low - 1e-9 <= np.array(r["v"])).all() and (np.array(r["v"]) <= high + 1e-9).all() for r in made)
    over, under = neighbors.smote_rates(df, "y")
    assert (over, under) == (2.0, 1.0)


def test_stepwise_and_pvalues(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = 2 * x[:, 0] - x[:, 2] + rng.normal(size=300)
    df = spark.createDataFrame([tuple(map(float, [*r, t])) for r, t in zip(x, y)], "a double, b double, c double, y double")
    found = select.stepwise(df, "y", ["a", "b", "c"]).orderBy("place").collect()
    assert [r["feature"] for r in found] == ["a", "c"] and all(r["p_value"] < 1e-6 for r in found)
    assert [r["coefficient"] for r in found] == pytest.approx([2, -1], abs=0.2)
    assert select.stepwise(df, "y", []).count() == 0
    assert select._t_tail(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert select._t_tail(0.5, 3) == pytest.approx(0.6514480, abs=1e-6)


def test_ks_pvalues(spark):
    # fixed values: 1 minus the published table of the limiting distribution
    for shift, statistic, tail in ((20, 0.1, 0.270000), (24, 0.12, 0.112250), (32, 0.16, 0.011952)):
        a = spark.range(200).select(F.col("id").cast("double").alias("x"))
        b = spark.range(200).select((F.col("id") + shift).cast("double").alias("x"))
        row = stats.ks_2samp(a, b, ["x"]).first()
        assert row["statistic"] == pytest.approx(statistic)
        assert row["pvalue"] == pytest.approx(tail, abs=1e-6)


def test_ks_pvalue_shape(spark):
    a = spark.range(0, 400).select(F.col("id").cast("double").alias("x"))
    b = spark.range(0, 400).select((F.col("id") + 200).cast("double").alias("x"))
    row = stats.ks_2samp(a, b, ["x"]).first()
    assert row["statistic"] == 0.5 and row["pvalue"] < 1e-10
    assert stats.ks_2samp(a, a, ["x"]).first()["pvalue"] == 1.0


def test_sampled_parameters():
    space = {"depth": [2, 9], "rate": [0.01, 0.1, "log-uniform"], "kind": ["a", "b", "list"], "fixed": 3}
    for p in models.sample_params(space, 20):
        assert 2 <= p["depth"] < 9 and 0.01 <= p["rate"] <= 0.1 and p["kind"] in "ab" and p["fixed"] == 3


def test_bytes_and_phrases(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff!"),), (bytearray("é".encode()),)], "b binary")
    assert values(df.select(text.to_text("b").alias("t")), "t") == ["ok!", "é"]
    row = spark.createDataFrame([("Cool Off now",)], "t string").select(text.substitute("t", {"cool off": "[u]"}).alias("t")).first()
    assert row["t"] == "[u] now"


def test_stream_day_series(spark, tmp_path):
    from quarrymill.streaming import stream_daily_series

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    out = stream_daily_series(stream, "ts", "value", F.col("event_type") == "purchase")
    q = out.writeStream.outputMode("complete").format("memory").queryName("days").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = stream_daily_series(events, "ts", "value", F.col("event_type") == "purchase")
    assert spark.table("days").select("date", "n").exceptAll(want.select("date", "n")).isEmpty()
