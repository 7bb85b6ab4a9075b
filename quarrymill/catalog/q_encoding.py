"""E: bins, encoders, feature dictionaries."""

from pyspark.sql import functions as F

from ..functions.arrays import one_hot_vector
from ..functions.binning import cut, cut_code, cut_step
from ..functions.text import tokens
from ..operators import encoding as E
from .q_sources import FIELDS, INDEX_SQL, LIBSVM_SQL
from .registry import load, query, r

# Bin edges
PRICE_EDGES = [0, 1000, 50000, 100000, 200000, 300000, 400000]


def _case(x, edges, labels, low="<", high="<="):
    parts = " ".join(f"WHEN {x} {'>' if high == '<=' else '>='} {a} AND {x} {high} {b} THEN {v}" for a, b, v in zip(edges, edges[1:], labels))
    return f"CASE {parts} END"


@query("e01_cut_right", f"""
SELECT o_orderkey, {_case('o_totalprice', PRICE_EDGES, [f"'({a}, {b}]'" for a, b in zip(PRICE_EDGES, PRICE_EDGES[1:])])} AS bin,
  {_case('o_totalprice', PRICE_EDGES, range(6))} AS code FROM orders""")
def cut_right(spark, d):
    return load(spark, d, "orders").select("o_orderkey", cut("o_totalprice", PRICE_EDGES).alias("bin"), cut_code("o_totalprice", PRICE_EDGES).alias("code"))


@query("e02_cut_left", f"""
SELECT o_orderkey, {_case('o_custkey', [0, 10, 100, 500, 1000], [f"'[{a}, {b})'" for a, b in ((0, 10), (10, 100), (100, 500), (500, 1000))], high='<')} AS bin FROM orders""")
def cut_left(spark, d):
    return load(spark, d, "orders").select("o_orderkey", cut("o_custkey", [0, 10, 100, 500, 1000], right=False).alias("bin"))


@query("e03_cut_labels", """
SELECT c_custkey, CASE WHEN c_acctbal >= -1000 AND c_acctbal <= 0 THEN 'debt' WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN 'some' WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'much' END AS bin FROM customer""")
def cut_labels(spark, d):
    return load(spark, d, "customer").select("c_custkey", cut("c_acctbal", [-1000, 0, 5000, 10000], include_lowest=True, labels=["debt", "some", "much"]).alias("bin"))


@query("e04_cut_step", "SELECT o_orderkey, CASE WHEN ceil(o_totalprice / 50000) - 1 BETWEEN 0 AND 7 THEN CAST(ceil(o_totalprice / 50000) - 1 AS INTEGER) END AS bin FROM orders")
def step_cut(spark, d):
    return load(spark, d, "orders").select("o_orderkey", cut_step("o_totalprice", 50000, 8).alias("bin"))


@query("e05_qcut", """
WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS e FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= e[1] THEN 'bad' WHEN o_totalprice <= e[2] THEN 'soso' WHEN o_totalprice <= e[3] THEN 'good' ELSE 'awesome' END AS bin FROM orders, q""")
def qcut(spark, d):
    out = E.qcut(load(spark, d, "orders"), "o_totalprice", 4, ["bad", "soso", "good", "awesome"], "bin")
    return out.select("o_orderkey", "bin")


@query("e05_qcut_repeated_edges", """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 3 THEN 1 WHEN l_linenumber <= 5 THEN 2 ELSE 3 END AS x FROM lineitem),
q AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.5) AS b, quantile_cont(x, 0.75) AS c FROM x)
SELECT l_orderkey, l_linenumber, greatest(CAST(x > 1 AND a > 1 AS INTEGER) + CAST(x > a AND b > a AS INTEGER) + CAST(x > b AND c > b AS INTEGER) + CAST(x > c AND 3 > c AS INTEGER)
 - CAST(a = 1 AND x > 1 AS INTEGER), 0) AS bin FROM x, q""")
def qcut_repeated(spark, d):
    x = F.when(F.col("l_linenumber") <= 3, 1).when(F.col("l_linenumber") <= 5, 2).otherwise(3)
    return E.qcut(load(spark, d, "lineitem").withColumn("x", x), "x", 4, name="bin").select("l_orderkey", "l_linenumber", "bin")


@query("e06_group_qcut", """
WITH k AS (SELECT c_custkey, c_mktsegment, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_mktsegment, c_acctbal) - 1) / 2 AS rk FROM customer),
q AS (SELECT c_mktsegment, quantile_cont(rk, [0.2, 0.4, 0.6, 0.8]) AS e FROM k GROUP BY 1)
SELECT c_custkey, CASE WHEN rk <= e[1] THEN 0 WHEN rk <= e[2] THEN 1 WHEN rk <= e[3] THEN 2 WHEN rk <= e[4] THEN 3 ELSE 4 END AS bin FROM k JOIN q USING (c_mktsegment)""")
def group_qcut(spark, d):
    return E.group_qcut(load(spark, d, "customer"), ["c_mktsegment"], "c_acctbal", 5, "bin", salt_on=["c_custkey"]).select("c_custkey", "bin")


@query("e07_ordinal_encoder", """
WITH t AS (SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) AS code FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW'))
SELECT o_orderkey, CAST(coalesce(code, 0) AS INTEGER) AS code FROM orders LEFT JOIN t ON o_orderpriority = v""")
def ordinal(spark, d):
    orders = load(spark, d, "orders")
    enc = E.OrdinalEncoder(["o_orderpriority"]).fit(orders.filter("o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW'"))
    return enc.transform(orders, ["o_orderkey"]).select("o_orderkey", F.col("o_orderpriority").alias("code"))


@query("e08_one_hot", """
SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS "c_mktsegment_AUTOMOBILE", CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
 CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE", CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
 CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY" FROM customer""")
def one_hot(spark, d):
    return E.one_hot(load(spark, d, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("e09_factorize", """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus, CAST(l_returnflag = 'A' AS INTEGER) AS "l_returnflag_A",
 CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N", CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R" FROM lineitem""")
def factorize(spark, d):
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    return E.factorize(line, ["l_linestatus", "l_returnflag"])


@query("e08_one_hot_sparse", """
WITH l AS (SELECT c_custkey, 1 AS b, 'c_name_' || c_name AS name, c_name AS v FROM customer UNION ALL SELECT c_custkey, 2, 'c_mktsegment_' || c_mktsegment, c_mktsegment FROM customer),
k AS (SELECT b, v, row_number() OVER (ORDER BY b, v) - 1 AS index FROM (SELECT DISTINCT b, v FROM l))
SELECT c_custkey, index, name FROM l JOIN k USING (b, v)""")
def one_hot_sparse(spark, d):
    """A column of as many values as rows, and one of few."""
    rows, names = E.one_hot_sparse(load(spark, d, "customer"), "c_custkey", ["c_name", "c_mktsegment"])
    return rows.select("c_custkey", F.explode("indices").alias("index")).join(names, "index").select("c_custkey", "index", "name")


@query("e09_factorize_sparse", """
WITH l AS (SELECT o_orderkey AS k, o_totalprice > 150000 AS s, o_orderstatus AS f, o_custkey AS p FROM orders),
a AS (SELECT f, row_number() OVER (ORDER BY f) AS i FROM (SELECT DISTINCT f FROM l)), n AS (SELECT count(*) AS n FROM a),
b AS (SELECT p, n.n + row_number() OVER (ORDER BY CAST(p AS VARCHAR)) AS i FROM (SELECT DISTINCT p FROM l), n)
SELECT k, array_to_string(list_concat(CASE WHEN s THEN [0] ELSE [] END, [a.i, b.i]), ',') AS ones FROM l JOIN a USING (f) JOIN b USING (p)""")
def factorize_sparse(spark, d):
    orders = load(spark, d, "orders").withColumn("large", F.when(F.col("o_totalprice") > 150000, "yes").otherwise("no"))
    rows, _ = E.factorize_sparse(orders, "o_orderkey", ["large", "o_orderstatus", "o_custkey"])
    return rows.select(F.col("o_orderkey").alias("k"), F.array_join(F.col("indices").cast("array<string>"), ",").alias("ones"))


@query("e10_binary_encode", """
WITH t AS (SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) AS c FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, CAST((c >> 2) & 1 AS INTEGER) AS o_orderpriority_0, CAST((c >> 1) & 1 AS INTEGER) AS o_orderpriority_1, CAST(c & 1 AS INTEGER) AS o_orderpriority_2 FROM orders JOIN t ON o_orderpriority = v""")
def binary(spark, d):
    return E.binary_encode(load(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], ["o_orderkey"]).drop("o_orderpriority")


@query("e11_label_encode", """
WITH t AS (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY o_orderstatus) - 1 AS label FROM (SELECT DISTINCT o_orderstatus FROM orders))
SELECT o_orderkey, label FROM orders JOIN t ON o_orderstatus = v""")
def labels(spark, d):
    return E.label_encode(load(spark, d, "orders"), "o_orderstatus").select("o_orderkey", F.col("label").cast("long").alias("label"))


PART_INDEX_SQL = """
WITH c AS (SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2),
p AS (SELECT DISTINCT field, CASE WHEN n / (SELECT count(*) FROM orders) < 0.001 THEN 'others' ELSE value END AS value FROM c)
SELECT field, value, CAST(row_number() OVER (ORDER BY field || ':' || value) - 1 AS BIGINT) AS idx FROM p"""


@query("e12_feature_index_pooled", PART_INDEX_SQL)
def pooled_index(spark, d):
    return E.build_feature_index(load(spark, d, "orders"), ["o_orderstatus", "o_custkey"]).select("field", "value", "idx")


@query("e13_tag_index", """
WITH t AS (SELECT DISTINCT unnest(string_split(array_to_string(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '' AND NOT contains(x, ',')), ','), ',')) AS value FROM documents),
a AS (SELECT value FROM t WHERE value <> '' UNION SELECT 'others')
SELECT value, CAST(row_number() OVER (ORDER BY 'tags:' || value) - 1 AS BIGINT) AS idx FROM a""")
def tag_index(spark, d):
    docs = load(spark, d, "documents")
    tags = docs.select("doc_id", F.array_join(F.filter(tokens("text"), lambda t: ~F.contains(t, F.lit(","))), ",").alias("tags"))
    return E.build_feature_index(tags, [], ["tags"]).select("value", "idx")


@query("e14_encode_rows", LIBSVM_SQL + """
SELECT o_orderkey, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices FROM e GROUP BY 1""")
def encode_rows(spark, d):
    orders = load(spark, d, "orders")
    index = E.build_feature_index(orders, FIELDS)
    return E.encode_rows(orders, "o_orderkey", index, FIELDS).select("o_orderkey", F.array_join("indices", ",").alias("indices"))


@query("e14_encode_pooled_rows", f"""
WITH ix AS ({PART_INDEX_SQL}),
e AS (SELECT o_orderkey, coalesce(b.idx, c.idx) AS i1, a.idx AS i2 FROM orders JOIN ix a ON a.field = 'o_orderstatus' AND a.value = o_orderstatus
 LEFT JOIN ix b ON b.field = 'o_custkey' AND b.value = CAST(o_custkey AS VARCHAR) LEFT JOIN ix c ON c.field = 'o_custkey' AND c.value = 'others')
SELECT o_orderkey, least(i1, i2) || ',' || greatest(i1, i2) AS indices FROM e""")
def encode_pooled(spark, d):
    orders = load(spark, d, "orders")
    cols = ["o_orderstatus", "o_custkey"]
    return E.encode_rows(orders, "o_orderkey", E.build_feature_index(orders, cols), cols).select("o_orderkey", F.array_join("indices", ",").alias("indices"))


CUST_DICT_SQL = """
WITH m AS (SELECT DISTINCT c_mktsegment AS v FROM customer), n AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS v FROM customer),
x AS (SELECT 0 AS place, 'c_acctbal' AS field, '' AS value UNION ALL SELECT 1, 'c_mktsegment', v FROM m UNION ALL SELECT 2, 'c_nationkey', v FROM n),
ix AS (SELECT *, row_number() OVER (ORDER BY place, value) - 1 AS idx FROM x)
"""


def _cust_dict(spark, d):
    cust = load(spark, d, "customer")
    even, odd = cust.filter("c_custkey % 2 = 0"), cust.filter("c_custkey % 2 = 1")
    return cust, E.FeatureDictionary(["c_acctbal"], ["c_mktsegment", "c_nationkey"]).fit(even, odd)


@query("e15_feature_dictionary", CUST_DICT_SQL + "SELECT field, value, CAST(idx AS BIGINT) AS idx FROM ix")
def feature_dictionary(spark, d):
    return _cust_dict(spark, d)[1].state.select("field", "value", "idx")


@query("e16_parse_rows", CUST_DICT_SQL + """
SELECT c_custkey, '0,' || a.idx || ',' || b.idx AS xi, round(c_acctbal, 4) AS x0, CAST(1 AS DOUBLE) AS x1, CAST(1 AS DOUBLE) AS x2
FROM customer JOIN ix a ON a.place = 1 AND a.value = c_mktsegment JOIN ix b ON b.place = 2 AND b.value = CAST(c_nationkey AS VARCHAR)""")
def parse_rows(spark, d):
    cust, dictionary = _cust_dict(spark, d)
    out = dictionary.transform(cust, "c_custkey")
    return out.select("c_custkey", F.array_join("xi", ",").alias("xi"), r(F.col("xv")[0], 4).alias("x0"), F.col("xv")[1].alias("x1"), F.col("xv")[2].alias("x2"))


@query("e17_split_fields", LIBSVM_SQL + """
SELECT o_orderkey, min(idx - (SELECT min(idx) FROM ix i WHERE i.field = 'o_orderpriority')) FILTER (WHERE idx >= (SELECT min(idx) FROM ix i WHERE i.field = 'o_orderpriority') AND idx <= (SELECT max(idx) FROM ix i WHERE i.field = 'o_orderpriority')) AS o_orderpriority,
 min(idx - (SELECT min(idx) FROM ix i WHERE i.field = 'o_orderstatus')) FILTER (WHERE idx >= (SELECT min(idx) FROM ix i WHERE i.field = 'o_orderstatus') AND idx <= (SELECT max(idx) FROM ix i WHERE i.field = 'o_orderstatus')) AS o_orderstatus FROM e GROUP BY 1""")
def split_fields(spark, d):
    orders = load(spark, d, "orders")
    index = E.build_feature_index(orders, FIELDS)
    rows = E.encode_rows(orders, "o_orderkey", index, FIELDS)
    out = E.split_fields(rows, "indices", E.field_offsets(index))
    return out.select("o_orderkey", *[F.array_min(c).alias(c) for c in FIELDS])


@query("e18_detect_categoricals", """
SELECT 'l_linenumber' AS feature UNION ALL SELECT 'l_quantity'""")
def detect(spark, d):
    line = load(spark, d, "lineitem")
    found = E.detect_categoricals(line, ["l_linenumber", "l_quantity", "l_discount", "l_extendedprice", "l_orderkey"])
    names = F.array(*[F.lit(c) for c in found]).cast("array<string>")
    return line.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.explode(names).alias("feature"))


@query("e19_items", "SELECT l_orderkey, l_linenumber, 'l_returnflag:' || l_returnflag || '|l_linestatus:' || l_linestatus AS items FROM lineitem")
def items(spark, d):
    out = E.to_items(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])
    return out.select("l_orderkey", "l_linenumber", F.array_join("items", "|").alias("items"))


@query("e20_one_hot_vector", "SELECT vec_id, array_to_string(list_transform(range(0, 10), lambda i: CAST(i = label AS INTEGER)), ',') AS v FROM embeddings")
def hot_vector(spark, d):
    return load(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(one_hot_vector("label", 10), lambda x: x.cast("string")), ",").alias("v"))
