"""L: metrics on labels with a pseudo-score drawn from the document id and shifted by the label."""

from pyspark.sql import functions as F

from ..functions.arrays import softmax
from ..functions.hashing import hash_fold, key_hash
from ..operators import metrics as M
from .registry import load, query, r

BASE = """
WITH b AS (SELECT doc_id, quality AS y, CAST((CAST('0x' || substr(md5('score:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 80 + quality * 20) AS DOUBLE) / 100 AS p,
 CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold FROM labels)
"""


def scored(spark, d):
    labels = load(spark, d, "labels")
    p = (key_hash("doc_id", "score") % 80 + F.col("quality") * 20).cast("double") / 100
    return labels.select("doc_id", F.col("quality").alias("y"), p.alias("p"), hash_fold("doc_id", 3).alias("fold"))


def classed(spark, d):
    rows = load(spark, d, "embeddings")
    return rows.select("vec_id", F.col("label").alias("y"), (F.abs(F.col("label") + F.when(key_hash("vec_id", "flip") % 3 == 0, 1).otherwise(0)) % 10).cast("int").alias("p"))


CLASSED = """
WITH b AS (SELECT vec_id, label AS y, CAST((label + CASE WHEN CAST('0x' || substr(md5('flip:' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END) % 10 AS INTEGER) AS p FROM embeddings),
k AS (SELECT DISTINCT y AS class FROM b UNION SELECT DISTINCT p FROM b),
c AS (SELECT class, count(*) FILTER (WHERE y = class AND p = class) AS tp, count(*) FILTER (WHERE y = class) AS support, count(*) FILTER (WHERE p = class) AS predicted FROM k, b GROUP BY 1),
f AS (SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
 CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1, support FROM c)
"""


@query("l01_confusion", BASE + "SELECT y, CAST(p > 0.5 AS INTEGER) AS p, count(*) AS n FROM b GROUP BY 1, 2")
def confusion(spark, d):
    return M.confusion(scored(spark, d).withColumn("p", (F.col("p") > 0.5).cast("int")), "y", "p")


@query("l02_binary_metrics", BASE + """
, c AS (SELECT count(*) FILTER (WHERE p > 0.4 AND y = 1) AS tp, count(*) FILTER (WHERE p > 0.4 AND y = 0) AS fp, count(*) FILTER (WHERE p <= 0.4 AND y = 1) AS fn, count(*) FILTER (WHERE p <= 0.4 AND y = 0) AS tn FROM b)
SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def binary(spark, d):
    out = M.binary_metrics(scored(spark, d), "y", "p", 0.4)
    return out.select(*[r(c).alias(c) for c in out.columns])


@query("l03_macro_f1", CLASSED + "SELECT round(avg(f1), 6) AS macro_f1 FROM f")
def macro(spark, d):
    return M.macro_f1(classed(spark, d), "y", "p").select(r("macro_f1").alias("macro_f1"))


@query("l04_class_report", CLASSED + "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f")
def report(spark, d):
    out = M.class_report(classed(spark, d), "y", "p")
    return out.select("class", r("precision").alias("precision"), r("recall").alias("recall"), r("f1").alias("f1"), "support")


@query("l05_roc_curve", BASE + """
, s AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY 1)
SELECT p AS threshold, round(sum(neg) OVER (ORDER BY p DESC) / sum(neg) OVER (), 6) AS fpr, round(sum(pos) OVER (ORDER BY p DESC) / sum(pos) OVER (), 6) AS tpr FROM s""")
def roc(spark, d):
    return M.roc_curve(scored(spark, d), "y", "p").select("threshold", r("fpr").alias("fpr"), r("tpr").alias("tpr"))


AUC = """, k AS (SELECT y, fold, rank() OVER ({w} ORDER BY p) + (count(*) OVER (PARTITION BY {part} p) - 1) / 2 AS rk FROM b)
SELECT {sel} round((sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) AS auc FROM k {grp}"""


@query("l05_auc", BASE + AUC.format(w="", part="", sel="", grp=""))
def auc(spark, d):
    return M.auc(scored(spark, d), "y", "p").select(r("auc").alias("auc"))


@query("l05_auc_by_fold", BASE + ", a AS (" + "WITH " + AUC.format(w="PARTITION BY fold", part="fold,", sel="fold,", grp="GROUP BY fold").lstrip(", ") .replace(", 6) AS auc", ", 15) AS auc") + ") SELECT round(avg(auc), 6) AS auc_mean, round(stddev_pop(auc), 6) AS auc_std FROM a")
def auc_by_fold(spark, d):
    return M.auc_by_fold(scored(spark, d), "y", "p").select(r("auc_mean").alias("auc_mean"), r("auc_std").alias("auc_std"))


@query("l06_auc_grid", BASE + """
, g AS (SELECT i, i / 999.0 AS t FROM range(0, 1000) x(i)), c AS (SELECT i, count(*) FILTER (WHERE p >= t AND y = 1) / (SELECT sum(y) FROM b) AS pta, count(*) FILTER (WHERE p >= t AND y = 0) / (SELECT sum(1 - y) FROM b) AS pfa FROM g, b GROUP BY i)
SELECT round(sum(pta * (prev - pfa)), 6) AS auc FROM (SELECT pta, pfa, lag(pfa, 1, 1.0) OVER (ORDER BY i) AS prev FROM c)""")
def auc_grid(spark, d):
    return M.auc_grid(scored(spark, d), "y", "p").select(r("auc").alias("auc"))


@query("l07_max_recall", BASE + """
, s AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY 1), w AS (SELECT sum(neg) OVER (ORDER BY p) AS cn, sum(pos) OVER (ORDER BY p) AS cp, sum(neg) OVER () AS tn FROM s)
SELECT round(coalesce(max(CASE WHEN cn / (cn + cp) >= 0.6 THEN cn / tn END), 0), 6) AS max_recall FROM w""")
def max_recall(spark, d):
    return M.max_recall(scored(spark, d), "y", "p", 0.6).select(r("max_recall").alias("max_recall"))


CUTS_SQL = BASE + f"""
, t AS (SELECT CAST(unnest([{', '.join(map(str, M.CUTS))}]) AS DOUBLE) AS threshold),
s AS (SELECT threshold, 2 * count(*) FILTER (WHERE p > threshold AND y = 1) / (count(*) FILTER (WHERE p > threshold) + sum(y)) AS f1 FROM t, b GROUP BY 1)
"""


@query("l08_threshold_scores", CUTS_SQL + "SELECT threshold, round(f1, 6) AS f1 FROM s")
def thresholds(spark, d):
    return M.ThresholdSelection().scores(scored(spark, d), "y", "p").withColumn("f1", r("f1"))


@query("l08_threshold_apply", CUTS_SQL + "SELECT doc_id, CAST(p > (SELECT threshold FROM s ORDER BY f1 DESC, threshold LIMIT 1) AS INTEGER) AS prediction FROM b")
def threshold_apply(spark, d):
    rows = scored(spark, d)
    return M.ThresholdSelection().fit(rows, "y", "p").transform(rows, "p").select("doc_id", "prediction")


@query("l09_regression_metrics", """
SELECT round(avg(e * e), 4) AS mse, round(sqrt(avg(e * e)), 4) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 1500 AS e FROM lineitem)""")
def regression(spark, d):
    rows = load(spark, d, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return M.regression_metrics(rows, "y", "p").select(r("mse", 4).alias("mse"), r("rmse", 4).alias("rmse"), r("r2").alias("r2"))


PROBS_SQL = """
WITH d AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
c AS (SELECT vec_id, label, i % 10 AS k, sum(v) * 4 AS s FROM d GROUP BY ALL), e AS (SELECT vec_id, label, list(s ORDER BY k) AS s FROM c GROUP BY ALL),
x AS (SELECT vec_id, label, list_transform(s, lambda v: exp(v - list_max(s))) AS x FROM e), p AS (SELECT vec_id, label, list_transform(x, lambda v: v / list_sum(x)) AS p FROM x)
"""


def probs(spark, d):
    rows = load(spark, d, "embeddings")
    # every tenth of the 64 dimensions votes for a class
    tenth = lambda k: F.filter(F.col("embedding").cast("array<double>"), lambda _, i: i % 10 == k)
    scores = F.array(*[F.aggregate(tenth(k), F.lit(0.0), lambda a, x: a + x) * 4 for k in range(10)])
    return rows.select("vec_id", "label", softmax(scores).alias("p"))


@query("l10_logloss", PROBS_SQL + "SELECT round(avg(-ln(p[label + 1])), 6) AS logloss FROM p")
def logloss(spark, d):
    return M.logloss(probs(spark, d), "label", "p").select(r("logloss").alias("logloss"))


@query("l11_gini_norm", """
WITH b AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_quantity AS y, l_discount AS p FROM lineitem),
g AS (SELECT sum(y * i) AS w, sum(y * j) AS best, sum(y) AS t, count(*) AS n FROM (SELECT y, row_number() OVER (ORDER BY p DESC, k, y) AS i, row_number() OVER (ORDER BY y DESC) AS j FROM b))
SELECT round(((n + 1) / 2 - w / t) / ((n + 1) / 2 - best / t), 6) AS gini FROM g""")
def gini(spark, d):
    line = load(spark, d, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return M.gini_norm(line, "l_quantity", "l_discount", "k").select(r("gini").alias("gini"))


@query("l12_kappa", BASE + """
, c AS (SELECT y, CAST(p > 0.5 AS INTEGER) AS q, count(*) OVER () AS n FROM b), a AS (SELECT avg(CAST(y = q AS INTEGER)) AS po, avg(y) * avg(q) + (1 - avg(y)) * (1 - avg(q)) AS pe FROM c)
SELECT round((po - pe) / (1 - pe), 6) AS kappa FROM a""")
def kappa(spark, d):
    return M.kappa(scored(spark, d).withColumn("q", (F.col("p") > 0.5).cast("int")), "y", "q").select(r("kappa").alias("kappa"))


@query("l13_cv_summary", BASE + """
, f AS (SELECT fold, avg(CAST((p > 0.5) = (y = 1) AS INTEGER)) AS accuracy FROM b GROUP BY 1) SELECT round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std FROM f""")
def cv(spark, d):
    out = M.cv_summary(M.binary_metrics(scored(spark, d), "y", "p", 0.5, ["fold"]), ["accuracy"])
    return out.select(*[r(c).alias(c) for c in out.columns])


@query("l15_active_units", """
WITH x AS (SELECT unnest(range(0, 64)) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
SELECT CAST(dim AS INTEGER) AS dim, round(var_samp(v), 8) AS variance, CAST(var_samp(v) >= 0.0155 AS INTEGER) AS active FROM x GROUP BY 1""")
def active(spark, d):
    return M.active_units(load(spark, d, "embeddings"), "embedding", 0.0155).withColumn("variance", r("variance", 8))


@query("l16_gaussian_mi", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), n AS (SELECT count(*) AS n FROM e),
d AS (SELECT a.vec_id, -0.5 * list_distance(a.v, b.v) ** 2 / exp(-2.0) - 0.5 * (64 * ln(2 * pi()) + 64 * -2.0) AS x FROM e a, e b),
m AS (SELECT vec_id, max(x) AS m FROM d GROUP BY 1), s AS (SELECT vec_id, any_value(m) + ln(sum(exp(x - m))) - ln(any_value(n)) AS q FROM d JOIN m USING (vec_id), n GROUP BY 1)
SELECT round(-0.5 * 64 * ln(2 * pi()) - 0.5 * 64 * (1 - 2.0) - avg(q), 6) AS mutual_information FROM s""")
def mi(spark, d):
    rows = load(spark, d, "embeddings").withColumn("lv", F.transform("embedding", lambda x: F.lit(-2.0)))
    return M.gaussian_mi(rows, "vec_id", "embedding", "lv").select(r("mutual_information").alias("mutual_information"))
