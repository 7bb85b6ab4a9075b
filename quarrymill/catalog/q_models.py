"""M9, N, T: fits, selection, searches, stacking and user functions. Fitted values are not compared."""

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import models as Mo
from ..operators import select as S
from ..operators import userfn as U
from ..plans.session import scratch_path
from .registry import load, query, r

LINE = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
DOC_COLS = ["n_chars", "n_words", "n_lines", "n_digits"]


def doc_features(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    rows = docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(tokens("text")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("n_digits"),
    )
    return rows.join(labels, "doc_id").withColumn("quality", F.col("quality").cast("double"))


def vectors(spark, d):
    return Mo.vectorise(load(spark, d, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))


def wide_vectors(spark, d, n=64):
    return S.explode_vector(load(spark, d, "embeddings"), "embedding", n)


def _fitted(df, key, prediction="prediction"):
    return df.select(key, r(prediction, 3).alias("prediction"))


@query("n01_anova_f", """
WITH x AS (SELECT label, unnest(range(0, 64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
c AS (SELECT i, label, count(*) AS n, avg(v) AS m, var_pop(v) * count(*) AS w FROM x GROUP BY 1, 2), g AS (SELECT i, avg(v) AS gm FROM x GROUP BY 1)
SELECT 'x' || i AS feature, round((sum(n * (m - gm) ** 2) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 5) AS f_value FROM c JOIN g USING (i) GROUP BY i""")
def anova(spark, d):
    return S.anova_f(wide_vectors(spark, d), "label", [f"x{i}" for i in range(64)]).withColumn("f_value", r("f_value", 5))


def _names(df, names):
    """Selected names as rows of a frame that depends on the data."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*[F.lit(n) for n in names]).cast("array<string>")).alias("feature"), "rows")


@query("n01_select_k_best")
def k_best(spark, d):
    df = wide_vectors(spark, d)
    return _names(df, S.select_k_best(df, "label", [f"x{i}" for i in range(64)], 3))


@query("n01_select_k_best_chi2")
def k_best_chi2(spark, d):
    df = load(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "A").cast("double")).withColumn("q", F.floor("l_quantity").cast("double"))
    return _names(df, S.select_k_best(df, "y", ["l_linenumber", "q"], 1, score="chi2"))


@query("n02_select_from_model")
def from_model(spark, d):
    df = doc_features(spark, d)
    return _names(df, S.select_from_model(df, "quality", DOC_COLS))


@query("n03_selector_report", """
SELECT 'missing' AS method, 'holes' AS feature UNION ALL SELECT 'single_unique', 'constant' UNION ALL SELECT 'collinear', 'price_net' UNION ALL SELECT 'collinear', 'holes'""")
def selector(spark, d):
    line = load(spark, d, "lineitem").select(
        *LINE,
        "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price_net"),
        F.lit(80).alias("constant"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_tax")).alias("holes"),
    )
    sel = S.FeatureSelector(line, cols=[c for c in line.columns if c != "l_orderkey"])
    return sel.identify_missing(0.5).identify_single_unique().identify_collinear(0.95).report()


# One-hot names and their places among the columns, numbers first
HOT_SQL = """
WITH c AS (SELECT c_custkey AS id, c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal * 2 + c_nationkey * 150 END AS twice, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN c_nationkey > 11 THEN 'high' ELSE 'low' END AS half FROM customer),
l AS (SELECT id, 0 AS o, 'c_acctbal' AS f, c_acctbal AS v FROM c UNION ALL SELECT id, 1, 'twice', twice FROM c WHERE twice IS NOT NULL
 UNION ALL SELECT id, 2, 'c_mktsegment_' || s, CAST(c_mktsegment = s AS DOUBLE) FROM c, (SELECT DISTINCT c_mktsegment AS s FROM c)
 UNION ALL SELECT id, 3, 'nation_' || s, CAST(nation = s AS DOUBLE) FROM c, (SELECT DISTINCT nation AS s FROM c)
 UNION ALL SELECT id, 4, 'half_' || s, CAST(half = s AS DOUBLE) FROM c, (SELECT DISTINCT half AS s FROM c))
SELECT b.f AS drop_feature, a.f AS corr_feature, round(corr(a.v, b.v), 6) AS corr_value FROM l a JOIN l b ON a.id = b.id AND (a.o, a.f) < (b.o, b.f) GROUP BY 1, 2 HAVING abs(corr(a.v, b.v)) > 0.18
"""


@query("n03_collinear_one_hot", HOT_SQL)
def collinear_one_hot(spark, d):
    """Collinear pairs among numbers and the one-hot columns of categories, from counts of value pairs."""
    from ..operators.profile import one_hot_correlated_pairs

    half = F.when(F.col("c_nationkey") > 11, "high").otherwise("low").alias("half")
    twice = F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal") * 2 + F.col("c_nationkey") * 150).alias("twice")
    rows = load(spark, d, "customer").select("c_acctbal", twice, "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"), half)
    out = one_hot_correlated_pairs(rows, ["c_acctbal", "twice"], ["c_mktsegment", "nation", "half"], 0.18)
    return out.withColumn("corr_value", r("corr_value"))


@query("n03_selector_importance")
def selector_importance(spark, d):
    df = doc_features(spark, d).drop("toxic").withColumn("flat", F.lit(1.0))
    sel = S.FeatureSelector(df, "quality", DOC_COLS + ["flat"])
    sel.identify_all(0.5, 0.999, 0.95)
    return sel.importances.select("feature", r("normalized", 3).alias("normalized"), r("cumulative", 3).alias("cumulative"))


@query("n04_stepwise")
def stepwise(spark, d):
    df = load(spark, d, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_quantity") * 100)
    return S.stepwise(df, "net", LINE).select("feature", "place", r("coefficient", 4).alias("coefficient"), r("p_value").alias("p_value"))


@query("n05_lasso")
def lasso(spark, d):
    df = load(spark, d, "lineitem").withColumn("noise", F.pmod(F.xxhash64("l_orderkey"), F.lit(97)).cast("double"))
    return _names(df, S.select_lasso(df, "l_extendedprice", LINE + ["noise"], reg=100.0))


@query("n05_lars")
def lars(spark, d):
    df = load(spark, d, "lineitem").withColumn("noise", F.pmod(F.xxhash64("l_orderkey"), F.lit(97)).cast("double"))
    return S.select_lars(df, "l_extendedprice", LINE + ["noise"], penalty=100.0).withColumn("coefficient", r("coefficient", 3))


@query("n06_rfe")
def rfe(spark, d):
    df = doc_features(spark, d)
    return _names(df, S.rfe(df, "quality", DOC_COLS, 2))


@query("n06_rfe_grid")
def rfe_grid(spark, d):
    _, table = S.rfe_grid(doc_features(spark, d), "doc_id", "quality", DOC_COLS, _auc(), 2)
    return table.select("n", r("score", 3).alias("score"), r("deviation", 3).alias("deviation"), "chosen")


@query("n07_pca")
def pca(spark, d):
    out = S.pca_block(wide_vectors(spark, d), [f"x{i}" for i in range(64)], 3)
    return out.select("vec_id", "label", *[r(F.abs(f"pc{i}"), 3).alias(f"pc{i}") for i in range(3)])


FITS = {
    "logistic": {"maxIter": 20},
    "linear_svm": {"maxIter": 10},
    "naive_bayes": {},
    "decision_tree": {"maxDepth": 4},
    "random_forest": {"numTrees": 10, "maxDepth": 4, "seed": 7},
    "boosted_trees": {"maxIter": 5, "seed": 7},
    "adaboost": {"maxIter": 5},
    "factorization_machine": {"maxIter": 10, "factorSize": 2, "seed": 7},
}


def _fit_query(name, params):
    @query(f"n08_{name}")
    def run(spark, d):
        rows = S.assemble(doc_features(spark, d), DOC_COLS).cache()
        return _fitted(Mo.fit_classifier(name, rows, "quality", params).transform(rows), "doc_id")

    return run


for _name, _params in FITS.items():
    _fit_query(_name, _params)


@query("n08_multiclass_logistic")
def multiclass(spark, d):
    rows = vectors(spark, d)
    return _fitted(Mo.fit_classifier("logistic", rows, "label", {"maxIter": 10}, classes=10).transform(rows), "vec_id")


def _reg_query(name, params):
    @query(f"n09_{name}")
    def run(spark, d):
        rows = S.assemble(load(spark, d, "lineitem"), LINE)
        out = Mo.fit_regressor(name, rows, "l_extendedprice", params).transform(rows)
        return out.select("l_orderkey", "l_linenumber", r("prediction", 0).alias("prediction"))

    return run


for _name, _params in {"linear": {}, "ridge": {}, "bayesian_ridge": {}, "lasso": {}, "boosted_trees": {"maxIter": 5, "seed": 7}, "random_forest": {"numTrees": 5, "seed": 7}}.items():
    _reg_query(_name, _params)


@query("n10_importance_table")
def importance(spark, d):
    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    model = Mo.fit_classifier("random_forest", rows, "quality", {"numTrees": 10, "seed": 7})
    table = S.importance_table(rows, DOC_COLS, model.featureImportances.toArray())
    return table.select("feature", r("normalized", 2).alias("normalized"), F.split("feature", "_")[1].alias("category"))


def _auc():
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(labelCol="quality")


@query("n11_random_search")
def random_search(spark, d):
    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    space = {"maxDepth": [2, 5], "minInfoGain": [1e-4, 1e-2, "log-uniform"], "impurity": ["gini", "entropy", "list"]}
    train, valid = rows.filter("doc_id % 4 <> 0"), rows.filter("doc_id % 4 = 0")
    _, table = Mo.random_search(lambda p: Mo.make_classifier("decision_tree", "quality", p), space, 3, train, valid, _auc())
    return table.select("run", "params", r("score", 3).alias("score"), "best")


@query("n12_grid_search")
def grid_search(spark, d):
    from pyspark.ml.tuning import ParamGridBuilder

    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    est = Mo.make_classifier("logistic", "quality", {"maxIter": 10})
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 0.1]).build()
    model = Mo.grid_search(est, grid, rows, _auc(), "doc_id", "quality", 2)
    return _fitted(model.transform(rows), "doc_id")


@query("n13_model_per_category", """
WITH b AS (SELECT l_suppkey, l_quantity, sum(l_extendedprice) AS s, count(*) AS n FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_suppkey, l_quantity AS v, sum(s) OVER w AS ls, sum(n) OVER w AS ln, sum(s) OVER (PARTITION BY l_suppkey) AS ts, sum(n) OVER (PARTITION BY l_suppkey) AS tn,
lead(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS nxt FROM b WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_quantity)),
g AS (SELECT l_suppkey, (v + nxt) / 2 AS cut, ls / ln AS low, (ts - ls) / (tn - ln) AS high, ls * ls / ln + (ts - ls) ** 2 / (tn - ln) - ts * ts / tn AS gain FROM c WHERE tn > ln),
k AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY gain DESC, cut) = 1), m AS (SELECT DISTINCT l_suppkey, ts / tn AS mean FROM c)
SELECT l_orderkey, l_linenumber, l_suppkey, round(coalesce(CASE WHEN l_quantity <= cut THEN low ELSE high END, mean), 2) AS prediction FROM lineitem JOIN m USING (l_suppkey) LEFT JOIN k USING (l_suppkey)""")
def per_category(spark, d):
    """A regression tree of one cut for every supplier."""
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    model = Mo.fit_by_category("decision_tree", line, "l_suppkey", "l_extendedprice", ["l_quantity"], {"maxDepth": 1})
    out = Mo.predict_by_category(model, line, "l_suppkey")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", r("prediction", 2).alias("prediction"))


@query("n13_forest_by_category")
def forest_per_category(spark, d):
    """A forest for every market segment; its draws have no SQL form, the tests hold trees against brute force."""
    rows = load(spark, d, "customer").withColumn("nation", F.col("c_nationkey").cast("double"))
    model = Mo.fit_by_category("random_forest", rows, "c_mktsegment", "c_acctbal", ["nation", "c_custkey"], {"numTrees": 4, "maxDepth": 2})
    return Mo.predict_by_category(model, rows, "c_mktsegment").select("c_custkey", "c_mktsegment", r("prediction", 3).alias("prediction"))


@query("n13_linear_by_category", """
WITH m AS (SELECT l_suppkey, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS w, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem GROUP BY 1 HAVING var_pop(l_quantity) > 0)
SELECT l_orderkey, l_linenumber, l_suppkey, round(b + w * l_quantity, 2) AS prediction FROM lineitem JOIN m USING (l_suppkey)""")
def linear_per_category(spark, d):
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    models = Mo.linear_by_category(line, "l_suppkey", "l_extendedprice", ["l_quantity"])
    varied = line.groupBy("l_suppkey").agg(F.var_pop("l_quantity").alias("v")).filter("v > 0").select(F.col("l_suppkey").alias("category"))
    out = Mo.predict_linear_by_category(models.join(varied, "category"), line, "l_suppkey", ["l_quantity"])
    return out.filter("prediction IS NOT NULL").select("l_orderkey", "l_linenumber", "l_suppkey", r("prediction", 2).alias("prediction"))


@query("n14_fit_transform_steps")
def steps(spark, d):
    """Fit once, save, load, apply to other rows."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    rows = doc_features(spark, d)
    stages = [
        Mo.ColumnStep("n_chars", "log_chars", "log1p"),
        VectorAssembler(inputCols=["log_chars", "n_words"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        Mo.make_classifier("logistic", "quality", {"maxIter": 10}),
    ]
    path = scratch_path(spark, "steps")
    Mo.fit_steps(rows.filter("doc_id % 2 = 0"), stages).write().overwrite().save(path)
    return _fitted(PipelineModel.load(path).transform(rows.filter("doc_id % 2 = 1")), "doc_id")


@query("l14_validation_curve")
def validation_curve(spark, d):
    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    make = lambda depth: Mo.make_classifier("decision_tree", "quality", {"maxDepth": depth})
    return Mo.validation_curve(make, [1, 3], rows, "doc_id", "quality", _auc().evaluate, 2).withColumn("score", r("score", 3))


@query("m09_stacked_model")
def stacked(spark, d):
    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    model = Mo.StackedModel(
        [("tree", "decision_tree", {"maxDepth": 3}), ("linear", "logistic", {"maxIter": 10})], ("logistic", {"maxIter": 10}), "doc_id", "quality", 2, folds=2
    ).fit(rows.filter("doc_id % 2 = 0"))
    return _fitted(model.transform(rows.filter("doc_id % 2 = 1")), "doc_id")


@query("t01_group_function", "SELECT o_orderpriority, round(sqrt(sum(o_totalprice ** 2) / count(*)), 3) AS rms FROM orders GROUP BY 1")
def group_function(spark, d):
    from ..operators.aggregate import group_agg

    rms = ("rms", lambda c: F.sqrt(F.sum(c * c) / F.count(c)))
    out = group_agg(load(spark, d, "orders"), ["o_orderpriority"], [("o_totalprice", rms)], names=lambda c, f: f)
    return out.withColumn("rms", r("rms", 3))


@query("t02_cell_function", "SELECT c_custkey, upper(c_mktsegment) || '-' || length(c_mktsegment) AS tag FROM customer")
def cell_function(spark, d):
    return U.map_cells(load(spark, d, "customer"), "c_mktsegment", lambda v: f"{v.upper()}-{len(v)}", "string", "tag").select("c_custkey", "tag")


@query("t02_row_function", "SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS tag FROM customer")
def row_function(spark, d):
    pick = lambda row: row["c_name"] if row["c_nationkey"] % 2 else row["c_mktsegment"]
    return U.apply_rows(load(spark, d, "customer"), ["c_nationkey", "c_name", "c_mktsegment"], pick, "string", "tag").select("c_custkey", "tag")


@query("t04_function_steps", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price, o_orderpriority[1:1] AS level FROM orders WHERE o_orderstatus <> 'P'")
def function_steps(spark, d):
    """Functions wrapped as steps, saved and loaded with their pipeline."""
    from pyspark.ml import PipelineModel

    orders = load(spark, d, "orders")
    steps = [
        U.FunctionStep(lambda df: df.filter("o_orderstatus <> 'P'")),
        U.FunctionStep(lambda df: df.withColumn("level", F.substring("o_orderpriority", 1, 1))),
        Mo.ColumnStep("o_totalprice", "log_price", "log1p"),
    ]
    path = scratch_path(spark, "steps")
    Mo.fit_steps(orders, steps).write().overwrite().save(path)
    return PipelineModel.load(path).transform(orders).select("o_orderkey", r("log_price").alias("log_price"), "level")


@query("t05_evaluator", """
SELECT 'abs_error' AS score, round(avg(abs(l_extendedprice - 1000 * l_quantity)), 4) AS value, 0 AS larger_better FROM lineitem
UNION ALL SELECT 'hits', avg(CAST(l_quantity > 25 AS INTEGER)), 1 FROM lineitem""")
def evaluator(spark, d):
    """Scores with their direction, as grid and random search take them."""
    line = load(spark, d, "lineitem")
    scores = {
        "abs_error": U.FunctionEvaluator(lambda df: df.agg(F.avg(F.abs(F.col("l_extendedprice") - 1000 * F.col("l_quantity")))).first()[0], False),
        "hits": U.FunctionEvaluator(lambda df: df.agg(F.avg((F.col("l_quantity") > 25).cast("int"))).first()[0]),
    }
    rows = [(name, round(e.evaluate(line), 4) if name == "abs_error" else e.evaluate(line), int(e.isLargerBetter())) for name, e in scores.items()]
    return spark.createDataFrame(rows, "score string, value double, larger_better int")


@query("t05_search_direction")
def search_direction(spark, d):
    """The same settings searched by an error and by its negative pick the same one."""
    rows = S.assemble(doc_features(spark, d), DOC_COLS)
    train, valid = rows.filter("doc_id % 4 <> 0"), rows.filter("doc_id % 4 = 0")
    error = lambda df: df.agg(F.avg((F.col("prediction") != F.col("quality")).cast("double"))).first()[0]
    make = lambda p: Mo.make_classifier("decision_tree", "quality", p)
    space = {"maxDepth": [1, 3, 5, "list"]}
    _, low = Mo.random_search(make, space, 2, train, valid, U.FunctionEvaluator(error, maximize=False))
    _, high = Mo.random_search(make, space, 2, train, valid, U.FunctionEvaluator(lambda df: -error(df)))
    both = low.withColumn("by", F.lit("error")).unionByName(high.withColumn("by", F.lit("negative")))
    return both.select("by", "run", "params", r("score", 3).alias("score"), "best")


@query("t06_partition_function", "SELECT o_orderkey, round(o_totalprice / 7, 8) AS x FROM orders")
def partition_function(spark, d):
    def part(frames):
        for f in frames:
            f["x"] = f["o_totalprice"] / 7
            yield f[["o_orderkey", "x"]]

    return load(spark, d, "orders").select("o_orderkey", "o_totalprice").mapInPandas(part, "o_orderkey long, x double").withColumn("x", r("x", 8))


@query("t07_record_expansion", "SELECT doc_id, CAST(i AS INTEGER) AS i, substr(t, i + 1, 1) AS ch FROM (SELECT doc_id, t, unnest(range(0, length(t))) AS i FROM (SELECT doc_id, lang || source AS t FROM documents))")
def expansion(spark, d):
    letters = F.split(F.concat("lang", "source"), "")
    return load(spark, d, "documents").select("doc_id", F.posexplode(letters).alias("i", "ch"))
