"""M: out-of-fold tables and blending."""

from pyspark.sql import functions as F

from ..functions.hashing import key_uniform
from ..operators import blend as B
from .q_metrics import PROBS_SQL, probs
from .q_split import h32
from .registry import load, query, r

# three fold predictions per event
FOLDED = f"""
WITH f AS (SELECT event_id, CAST(fold AS INTEGER) AS fold, round(({h32("event_id || ':' || fold", 'oof')}) / 4294967296.0, 6) + 0.000001 AS p FROM events, range(0, 3) x(fold))
"""


def folded(spark, d):
    events = load(spark, d, "events").select("event_id")
    tag = F.concat_ws(":", "event_id", "fold")
    rows = events.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return rows.withColumn("p", F.round(key_uniform(tag, "oof"), 6) + F.lit(0.000001))


@query("m01_oof_table", """
SELECT doc_id, CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold, 'base' AS model, CAST(quality AS DOUBLE) AS p FROM labels""")
def oof(spark, d):
    from ..operators.split import add_fold

    rows = add_fold(load(spark, d, "labels"), "doc_id", 3).withColumn("prediction", F.col("quality").cast("double"))
    return B.oof_table([(k, "base", rows.filter(F.col("fold") == k)) for k in range(3)], "doc_id", "prediction")


@query("m02_blend_mean", FOLDED + "SELECT event_id, round(avg(p), 8) AS prediction FROM f GROUP BY 1")
def mean(spark, d):
    return B.blend(folded(spark, d), "event_id", "p", "mean").withColumn("prediction", r("prediction", 8))


@query("m03_blend_gmean", FOLDED + "SELECT event_id, round(exp(avg(ln(p))), 8) AS prediction FROM f GROUP BY 1")
def gmean(spark, d):
    return B.blend(folded(spark, d), "event_id", "p", "gmean").withColumn("prediction", r("prediction", 8))


@query("m04_blend_rank_mean", FOLDED + """
, k AS (SELECT event_id, (1 + rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2) / (count(*) OVER (PARTITION BY fold) + 1) AS s FROM f)
SELECT event_id, round(avg(s), 8) AS prediction FROM k GROUP BY 1""")
def rank_mean(spark, d):
    return B.blend(folded(spark, d), "event_id", "p", "rank_mean").withColumn("prediction", r("prediction", 8))


@query("m05_average_models", FOLDED + "SELECT event_id, round(avg(p), 8) AS prediction FROM f GROUP BY 1")
def average(spark, d):
    return B.average_models(folded(spark, d), "event_id", "p").withColumn("prediction", r("prediction", 8))


@query("m06_soft_vote", PROBS_SQL + """
, q AS (SELECT vec_id, p, list_transform(range(0, 10), lambda i: 0.1) AS u FROM p), b AS (SELECT vec_id, list_transform(range(1, 11), lambda i: (2 * p[i] + 3 * u[i]) / 5) AS b FROM q)
SELECT vec_id, CAST(list_position(b, list_max(b)) - 1 AS INTEGER) AS prediction, round(list_max(b), 6) AS top FROM b""")
def soft_vote(spark, d):
    a = probs(spark, d).select("vec_id", F.lit("a").alias("model"), "p")
    b = a.select("vec_id", F.lit("b").alias("model"), F.array_repeat(F.lit(0.1), 10).alias("p"))
    out = B.soft_vote(a.unionByName(b), "vec_id", "model", "p", {"a": 2.0, "b": 3.0})
    return out.select("vec_id", "prediction", r(F.array_max("probs")).alias("top"))


@query("m07_softmax", PROBS_SQL + "SELECT vec_id, round(p[1], 6) AS p0, round(p[10], 6) AS p9 FROM p")
def soft(spark, d):
    return probs(spark, d).select("vec_id", r(F.col("p")[0]).alias("p0"), r(F.col("p")[9]).alias("p9"))


@query("m08_stack_features", PROBS_SQL + "SELECT vec_id, 20 AS width, round(p[1], 6) AS x0, round(p[1] / 2, 6) AS x10 FROM p")
def stack(spark, d):
    a = probs(spark, d).select("vec_id", F.lit("a").alias("model"), "p")
    b = a.select("vec_id", F.lit("b").alias("model"), F.transform("p", lambda x: x / 2).alias("p"))
    out = B.stack_features(b.unionByName(a), "vec_id", "model", "p")
    return out.select("vec_id", F.size("features").alias("width"), r(F.col("features")[0]).alias("x0"), r(F.col("features")[10]).alias("x10"))


@query("m10_model_agreement", FOLDED + """
, w AS (SELECT event_id, max(p) FILTER (WHERE fold = 0) AS a, max(p) FILTER (WHERE fold = 1) AS b, max(p) FILTER (WHERE fold = 2) AS c FROM f GROUP BY 1)
SELECT 'm0' AS a, 'm1' AS b, round(corr(a, b), 6) AS corr FROM w UNION ALL SELECT 'm0', 'm2', round(corr(a, c), 6) FROM w UNION ALL SELECT 'm1', 'm2', round(corr(b, c), 6) FROM w""")
def agreement(spark, d):
    rows = folded(spark, d).withColumn("model", F.concat(F.lit("m"), F.col("fold")))
    return B.model_agreement(rows, "event_id", "model", "p", ["m0", "m1", "m2"]).withColumn("corr", r("corr"))
