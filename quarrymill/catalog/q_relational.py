"""G, H, I, J: joins, set operations, sorts, top rows and ranks."""

from pyspark.sql import functions as F

from ..functions.arrays import argmax, unit
from ..operators import relational as R
from ..operators.aggregate import group_agg
from ..operators.blend import rank_scaled
from ..plans.scalars import Scalars
from ..plans.skew import lookup_join, salted_join
from .registry import load, query, r


@query("g01_left_join_stats", """
WITH s AS (SELECT l_suppkey, avg(l_quantity) AS m FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(m, 6) AS m FROM lineitem LEFT JOIN s USING (l_suppkey)""")
def left_join(spark, d):
    line = load(spark, d, "lineitem")
    stats = line.filter("l_suppkey % 5 <> 0").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("m"))
    return lookup_join(line, stats, ["l_suppkey"]).select("l_orderkey", "l_linenumber", r("m").alias("m"))


@query("g01_salted_join", """
WITH s AS (SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(m, 6) AS m FROM lineitem LEFT JOIN s USING (l_returnflag)""")
def hot_join(spark, d):
    """The way beyond the broadcast limit: three keys hold a third of the rows each."""
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    stats = line.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("m"))
    return salted_join(line, stats, ["l_returnflag"], salt_on=["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", r("m").alias("m"))


@query("g02_validated_join", """
SELECT o_orderkey, c FROM orders LEFT JOIN (SELECT l_orderkey, count(l_quantity) AS c FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def validated(spark, d):
    orders, line = load(spark, d, "orders", "lineitem")
    side = group_agg(line, ["l_orderkey"], [("l_quantity", "count")], names=lambda c, f: "c")
    return R.join_validated(orders, side, "o_orderkey", "l_orderkey", "1:1").select("o_orderkey", "c")


@query("g03_inner_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def inner(spark, d):
    orders, cust = load(spark, d, "orders", "customer")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_mktsegment")


@query("g04_importance_dictionary", """
WITH i AS (SELECT 'l_tax' AS feature, corr(l_tax, l_extendedprice) AS imp FROM lineitem UNION ALL SELECT 'l_quantity', corr(l_quantity, l_extendedprice) FROM lineitem)
SELECT feature, round(imp, 6) AS imp, CASE feature WHEN 'l_tax' THEN 'rate' ELSE 'amount' END AS category FROM i""")
def importance_dictionary(spark, d):
    from ..operators.profile import corr_matrix

    corr = corr_matrix(load(spark, d, "lineitem"), ["l_tax", "l_quantity", "l_extendedprice"]).filter("b = 'l_extendedprice'")
    imp = corr.select(F.col("a").alias("feature"), r("corr").alias("imp"))
    dictionary = spark.createDataFrame([("l_tax", "rate"), ("l_quantity", "amount"), ("l_discount", "rate")], "feature string, category string")
    return imp.join(F.broadcast(dictionary), "feature", "left")


@query("g05_concat_columns", "SELECT doc_id, n_chars, quality, toxic, n_chars * 2 AS twice FROM documents LEFT JOIN labels USING (doc_id)")
def concat_columns(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    return R.concat_columns([docs.select("doc_id", "n_chars"), labels, docs.select("doc_id", (F.col("n_chars") * 2).alias("twice"))], "doc_id")


@query("g06_lookup", "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' WHEN 2 THEN 'east' END AS side FROM nation")
def lookup(spark, d):
    return R.lookup(load(spark, d, "nation"), "n_regionkey", {0: "south", 1: "west", 2: "east"}, "side").select("n_nationkey", "side")


@query("g07_semi_anti", """
SELECT c_custkey, CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS INTEGER) AS large FROM customer""")
def semi_anti(spark, d):
    orders, cust = load(spark, d, "orders", "customer")
    keys = orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    has, has_not = R.semi(cust, keys, "c_custkey"), R.anti(cust, keys, "c_custkey")
    return has.select("c_custkey", F.lit(1).alias("large")).unionByName(has_not.select("c_custkey", F.lit(0).alias("large")))


@query("g08_scalar", "SELECT o_orderkey, round(o_totalprice - (SELECT max(o_totalprice) FROM orders), 4) AS gap FROM orders")
def scalar(spark, d):
    orders = load(spark, d, "orders")
    return orders.select("o_orderkey", r(F.col("o_totalprice") - Scalars(orders, top=F.max("o_totalprice"))["top"], 4).alias("gap"))


@query("h01_union_missing", """
SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_custkey FROM orders WHERE o_orderkey % 2 = 1""")
def union_missing(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return R.union_all(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1").drop("o_orderstatus"))


@query("h02_fold_union", "SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS fold FROM orders")
def fold_union(spark, d):
    orders = load(spark, d, "orders")
    return R.union_all(*[orders.filter(F.col("o_orderkey") % 3 == k).select("o_orderkey", F.lit(k).alias("fold")) for k in range(3)])


@query("h03_split_by_null", """
SELECT 'labelled' AS part, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL UNION ALL
SELECT 'unlabelled', count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def split_null(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    has, has_not = R.split_by_null(docs.select("doc_id").join(labels, "doc_id", "left"), "quality")
    count = F.count(F.lit(1)).alias("n")
    return has.agg(count).select(F.lit("labelled").alias("part"), "n").unionByName(has_not.agg(count).select(F.lit("unlabelled").alias("part"), "n"))


@query("h04_set_operations", """
SELECT 'distinct' AS op, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) UNION ALL
SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL
SELECT 'except_all', count(*) FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer)""")
def set_operations(spark, d):
    orders, cust = load(spark, d, "orders", "customer")
    a, b = orders.select("o_custkey"), cust.select("c_custkey")
    parts = [("distinct", a.distinct()), ("except", b.subtract(a)), ("except_all", a.exceptAll(b))]
    return R.union_all(*[df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n") for name, df in parts])


@query("i01_sort", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort(spark, d):
    return load(spark, d, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").select("o_orderkey", "o_custkey")


@query("i02_head", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500")
def head(spark, d):
    return R.head(load(spark, d, "orders").select("o_orderkey", "o_custkey"), 500, "o_orderkey")


@query("i03_top_k", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 905 ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def top_k(spark, d):
    return R.top_k(load(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 20, 905, ["p_partkey"])


@query("i04_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS at FROM embeddings")
def arg_max(spark, d):
    return load(spark, d, "embeddings").select("vec_id", argmax("embedding").alias("at"))


@query("i05_nearest", """
WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[])) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) / sqrt(list_dot_product(CAST(q AS DOUBLE[]), CAST(q AS DOUBLE[]))), 6) AS score
FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 10""")
def nearest(spark, d):
    vectors = load(spark, d, "embeddings")
    q = vectors.filter("vec_id = 0").first()["embedding"]
    return R.nearest(vectors, "embedding", q, 10, "vec_id").select("vec_id", r("score").alias("score"))


@query("i05_nearest_many", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n, label FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS neighbor, list_dot_product(a.v, b.v) / (a.n * b.n) AS s FROM e a, e b WHERE a.vec_id <> b.vec_id)
SELECT vec_id, neighbor, CAST(k AS INTEGER) AS rank, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, neighbor) AS k FROM p) WHERE k <= 3""")
def nearest_many(spark, d):
    """Many queries: nearest directions are nearest unit vectors, so the exact pivot search applies."""
    from ..operators.neighbors import knn

    vectors = load(spark, d, "embeddings").withColumn("embedding", unit("embedding"))
    found = knn(vectors, vectors, "vec_id", "embedding", 3, exclude_self=True)
    return found.select("vec_id", "neighbor", F.col("rank").cast("int").alias("rank"), r(1 - F.col("distance") * F.col("distance") / 2).alias("score"))


@query("i06_order_by_length", "SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS INTEGER) AS n FROM documents ORDER BY n DESC, doc_id")
def by_length(spark, d):
    from ..functions.text import tokens

    return load(spark, d, "documents").select("doc_id", F.size(tokens("text")).alias("n")).orderBy(F.col("n").desc(), "doc_id")


@query("j01_rank_scaled", """
SELECT event_id, round((1 + rank() OVER (PARTITION BY event_id % 5 ORDER BY value) + (count(*) OVER (PARTITION BY event_id % 5, value) - 1) / 2) / (count(*) OVER (PARTITION BY event_id % 5) + 1), 8) AS s FROM events""")
def ranks(spark, d):
    events = load(spark, d, "events").withColumn("fold", F.col("event_id") % 5)
    return rank_scaled(events, "value", ["fold"], "s", ["event_id"]).select("event_id", r("s", 8).alias("s"))


@query("j02_dense_rank_desc", "SELECT p_size, dense_rank() OVER (ORDER BY p_size DESC) AS dense_rank, count(*) AS n FROM part GROUP BY p_size")
def dense(spark, d):
    return R.dense_rank_desc(load(spark, d, "part"), "p_size")


@query("j03_cumulative_share", """
SELECT p_partkey, round(p_retailprice / sum(p_retailprice) OVER (), 8) AS share, round(sum(p_retailprice) OVER (ORDER BY p_retailprice DESC, p_partkey) / sum(p_retailprice) OVER (), 8) AS cumulative FROM part""")
def cumulative(spark, d):
    out = R.cumulative_share(load(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")
    return out.select("p_partkey", r("share", 8).alias("share"), r("cumulative", 8).alias("cumulative"))
