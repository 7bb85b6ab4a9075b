"""K: splits, folds, resampling."""

from pyspark.sql import functions as F

from ..operators import neighbors as N
from ..operators import split as S
from .registry import load, query, r


def h32(key, seed=""):
    text = f"'{seed}:' || CAST({key} AS VARCHAR)" if seed else f"CAST({key} AS VARCHAR)"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


@query("k01_random_split", f"SELECT o_orderkey, CASE WHEN {h32('o_orderkey', 'split')} / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders")
def random_split(spark, d):
    return S.random_split(load(spark, d, "orders"), "o_orderkey", 0.8).select("o_orderkey", "split")


@query("k02_stratified_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY {h32('doc_id', 'split')}, doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.7) THEN 'train' ELSE 'test' END AS split FROM labels""")
def stratified(spark, d):
    return S.stratified_split(load(spark, d, "labels"), "doc_id", "quality", 0.7).select("doc_id", "split")


@query("k03_stratified_folds", f"""
SELECT doc_id, CAST((row_number() OVER (PARTITION BY quality ORDER BY {h32('doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""")
def folds(spark, d):
    return S.add_fold(load(spark, d, "labels"), "doc_id", 5, "quality").select("doc_id", "fold")


@query("k04_hash_folds", f"SELECT doc_id, CAST({h32('doc_id')} % 5 AS INTEGER) AS fold FROM documents")
def hash_folds(spark, d):
    return S.add_fold(load(spark, d, "documents"), "doc_id", 5).select("doc_id", "fold")


@query("k05_time_split_rows", """
WITH n AS (SELECT event_id, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS day_num FROM events)
SELECT CASE WHEN day_num <= floor(0.7 * (SELECT max(day_num) FROM n)) THEN 'train' ELSE 'valid' END AS split, count(*) AS n FROM n GROUP BY 1""")
def time_rows(spark, d):
    from ..operators.timeline import day_num, time_split

    events = day_num(load(spark, d, "events").withColumn("date", F.to_date("ts")), "date")
    return time_split(events, "day_num", 0.7).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("k06_shuffle", f"SELECT o_orderkey FROM orders ORDER BY {h32('o_orderkey', 'shuffle')}, o_orderkey")
def shuffle(spark, d):
    return S.shuffle_rows(load(spark, d, "orders"), "o_orderkey").select("o_orderkey")


@query("k07_append_pseudo", f"""
SELECT doc_id, CAST(quality AS DOUBLE) AS label, 0 AS pseudo FROM labels UNION ALL
SELECT doc_id, round({h32('doc_id', 'soft')} / 4294967296.0, 6), 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND (doc_id >= 0 AND doc_id < 100 OR doc_id >= 150)""")
def pseudo(spark, d):
    from ..functions.hashing import key_uniform

    docs, labels = load(spark, d, "documents", "labels")
    train = labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    rest = docs.select("doc_id").join(labels, "doc_id", "left_anti")
    soft = rest.select("doc_id", r(key_uniform("doc_id", "soft")).alias("label"))
    return S.append_pseudo(train, rest, soft, "doc_id", [(0, 100), (150, None)])


@query("k08_undersample", f"""
SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {h32('doc_id', 'under')}, doc_id) AS k FROM labels) WHERE toxic <> 0 OR k <= 20""")
def undersample(spark, d):
    return S.undersample(load(spark, d, "labels"), "doc_id", "toxic", counts={0: 20}).select("doc_id", "toxic")


@query("k08_undersample_multiplier", f"""
SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {h32('doc_id', 'under')}, doc_id) AS k, count(*) OVER (PARTITION BY toxic) AS n FROM labels)
WHERE k <= floor(n * CASE toxic WHEN 0 THEN 0.5 ELSE 0.75 END)""")
def undersample_multiplier(spark, d):
    return S.undersample(load(spark, d, "labels"), "doc_id", "toxic", multipliers={0: 0.5, 1: 0.75}).select("doc_id", "toxic")


@query("k09_smote")
def smote(spark, d):
    vectors = load(spark, d, "embeddings").withColumn("y", (F.col("label") == 0).cast("int"))
    out = N.smote(vectors, "vec_id", "embedding", "y", minority=1, k=5, over=1.5, under=2.0)
    return out.select("vec_id", "y", "copy", r(F.col("embedding")[0]).alias("x0"), r(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)).alias("total"))


KNN_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
"""


@query("k10_edited_neighbors", KNN_SQL + """
rare AS (SELECT label FROM e GROUP BY 1 ORDER BY count(*), label LIMIT 1),
p AS (SELECT a.vec_id, a.label AS own, b.label AS vote, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k FROM e a, e b WHERE a.vec_id <> b.vec_id AND a.label <> (SELECT label FROM rare)),
c AS (SELECT vec_id, own, vote, count(*) AS n FROM p WHERE k <= 3 GROUP BY 1, 2, 3),
w AS (SELECT vec_id, own, vote, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) AS k FROM c)
SELECT vec_id, label FROM e WHERE vec_id NOT IN (SELECT vec_id FROM w WHERE k = 1 AND own <> vote)""")
def edited(spark, d):
    return N.edited_neighbors(load(spark, d, "embeddings"), "vec_id", "embedding", "label", 3).select("vec_id", "label")


@query("k10_edited_neighbors_repeated")
def edited_repeated(spark, d):
    return N.edited_neighbors(load(spark, d, "embeddings"), "vec_id", "embedding", "label", 3, repeats=3).select("vec_id", "label")


@query("k11_class_weights", "SELECT doc_id, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels")
def class_weights(spark, d):
    return S.class_weights(load(spark, d, "labels"), "quality").select("doc_id", r("weight").alias("weight"))


@query("n15_knn_classify", KNN_SQL + """
p AS (SELECT a.vec_id, b.label AS vote, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k FROM e a, e b WHERE a.vec_id % 2 = 1 AND b.vec_id % 2 = 0),
c AS (SELECT vec_id, vote, count(*) AS n FROM p WHERE k <= 5 GROUP BY 1, 2)
SELECT vec_id, prediction FROM (SELECT vec_id, vote AS prediction, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) AS k FROM c) WHERE k = 1""")
def knn_classify(spark, d):
    vectors = load(spark, d, "embeddings")
    return N.knn_classify(vectors.filter("vec_id % 2 = 0"), vectors.filter("vec_id % 2 = 1"), "vec_id", "embedding", "label", 5)
