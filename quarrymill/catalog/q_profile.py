"""F: profiles, correlation, histograms, rasters."""

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators.columns import mode_table
from .registry import load, query, r

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols, table, group=None):
    out = []
    for c in cols:
        key = group or f"'{c}' AS feature"
        out.append(f"""SELECT {key}, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
 round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {table}{' GROUP BY 1' if group else ''}""")
    return " UNION ALL ".join(out)


def _rounded_describe(df, key):
    return df.select(key, "count", r("mean", 4).alias("mean"), r("std", 4).alias("std"), F.col("min").cast("double").alias("min"), r("q25", 4).alias("q25"), r("q50", 4).alias("q50"), r("q75", 4).alias("q75"), F.col("max").cast("double").alias("max"))


@query("f07_describe", _describe_sql(["o_orderkey", "o_custkey", "o_totalprice"], "orders"))
def describe(spark, d):
    return _rounded_describe(P.describe(load(spark, d, "orders")), "feature")


@query("f08_describe_by", _describe_sql(["o_totalprice"], "orders", "o_orderpriority"))
def describe_by(spark, d):
    return _rounded_describe(P.describe_by(load(spark, d, "orders"), ["o_orderpriority"], "o_totalprice"), "o_orderpriority")


@query("f09_value_counts", "SELECT o_orderpriority, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1")
def value_counts(spark, d):
    return P.value_counts(load(spark, d, "orders"), "o_orderpriority").withColumn("share", r("share"))


@query("f10_missing_report", """
WITH h AS (SELECT CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id, count(*) OVER () AS n FROM events)
SELECT 'value' AS feature, count(*) - count(value) AS missing, round((count(*) - count(value)) / count(*), 6) AS fraction FROM h UNION ALL
SELECT 'user_id', count(*) - count(user_id), round((count(*) - count(user_id)) / count(*), 6) FROM h""")
def missing(spark, d):
    from .q_columns import _holes

    return P.missing_report(_holes(load(spark, d, "events")), 0.05).withColumn("fraction", r("fraction"))


@query("f11_unique_report", """
SELECT 'o_custkey' AS feature, count(DISTINCT o_custkey) AS n_unique, CAST(count(DISTINCT o_custkey) <= 1 AS INTEGER) AS single_valued FROM orders UNION ALL
SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), 0 FROM orders UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), 0 FROM orders UNION ALL SELECT 'one', 1, 1""")
def uniques(spark, d):
    return P.unique_report(load(spark, d, "orders").withColumn("one", F.lit(1)), ["o_custkey", "o_orderstatus", "o_orderpriority", "one"])


@query("f12_minmax_report", " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, 0 AS all_null FROM lineitem" for c in LINE))
def minmax(spark, d):
    return P.minmax_report(load(spark, d, "lineitem"), LINE)


@query("f13_pivot_percent", """
WITH c AS (SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS "column", count(*) AS n FROM orders GROUP BY 1, 2, 3),
b AS (SELECT * FROM c UNION ALL SELECT o_orderpriority, o_orderstatus, 'All', sum(n) FROM c GROUP BY 1, 2)
SELECT o_orderpriority, o_orderstatus, "column", CAST(n AS BIGINT) AS n, round(n * 100 / sum(n) OVER (PARTITION BY o_orderpriority, "column"), 2) AS percent FROM b""")
def pivot_percent(spark, d):
    orders = load(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    return P.pivot_percent(orders, "o_orderpriority", "o_orderstatus", "y")


@query("f14_crosstab", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def crosstab(spark, d):
    return P.crosstab(load(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@query("f15_group_share", "SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS share FROM orders GROUP BY 1, 2")
def group_share(spark, d):
    return P.group_share(load(spark, d, "orders"), "o_orderpriority", "o_orderstatus").withColumn("share", r("share"))


PAIRS = [(a, b) for i, a in enumerate(LINE) for b in LINE[i + 1 :]]


@query("f16_corr_pearson", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a, b in PAIRS))
def pearson(spark, d):
    return P.corr_matrix(load(spark, d, "lineitem"), LINE).withColumn("corr", r("corr"))


@query("f17_corr_spearman", "WITH k AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in LINE) + " FROM lineitem) "
       + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM k" for a, b in PAIRS))
def spearman(spark, d):
    line = load(spark, d, "lineitem").select(*LINE, F.xxhash64("l_orderkey", "l_linenumber").alias("row"))
    return P.corr_matrix(line, LINE, "spearman", "row").withColumn("corr", r("corr"))


@query("f17_corr_spearman_wide", """
WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
k AS (SELECT vec_id, dim, round(v, 2) AS v FROM e WHERE v > -0.1 OR dim % 2 = 0),
p AS (SELECT a.dim AS x, b.dim AS y, a.v AS va, b.v AS vb FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.dim < b.dim),
s AS (SELECT x, y, rank() OVER (PARTITION BY x, y ORDER BY va) + (count(*) OVER (PARTITION BY x, y, va) - 1) / 2 AS ra,
rank() OVER (PARTITION BY x, y ORDER BY vb) + (count(*) OVER (PARTITION BY x, y, vb) - 1) / 2 AS rb FROM p)
SELECT 'd' || x AS a, 'd' || y AS b, round(corr(ra, rb), 6) AS corr FROM s GROUP BY ALL""")
def spearman_wide(spark, d):
    """All pairs of a wide table with ties and missing values: each pair is ranked within the rows it shares."""
    v = lambda i: F.col("embedding")[i].cast("double")
    cell = lambda i: F.round(v(i), 2) if i % 2 else F.when(v(i) > -0.1, F.round(v(i), 2))
    wide = load(spark, d, "embeddings").select(*[cell(i).alias(f"d{i + 1}") for i in range(64)])
    return P.corr_matrix(wide, wide.columns, "spearman").withColumn("corr", r("corr"))


@query("f16_corr_wide", """
WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
k AS (SELECT vec_id, dim, CASE WHEN v > -0.1 THEN v END AS v FROM e)
SELECT 'd' || a.dim AS a, 'd' || b.dim AS b, round(corr(a.v, b.v), 6) AS corr FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.dim < b.dim GROUP BY ALL""")
def corr_wide(spark, d):
    """All pairs of a wide table with missing values."""
    v = lambda i: F.col("embedding")[i].cast("double")
    wide = load(spark, d, "embeddings").select(*[F.when(v(i) > -0.1, v(i)).alias(f"d{i + 1}") for i in range(64)])
    return P.corr_matrix(wide, wide.columns).withColumn("corr", r("corr"))


_WIDE = "SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS price_net, l_quantity * 2 + l_tax AS price_qty FROM lineitem"
_WCOLS = ["l_quantity", "l_extendedprice", "l_discount", "price_net", "price_qty"]
_WPAIRS = [(a, b) for i, a in enumerate(_WCOLS) for b in _WCOLS[i + 1 :]]
_CORR_LONG = f"WITH w AS ({_WIDE}), k AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM w" for a, b in _WPAIRS) + ") "


def _wide(spark, d):
    line = load(spark, d, "lineitem")
    return line.select("l_quantity", "l_extendedprice", "l_discount", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price_net"), (F.col("l_quantity") * 2 + F.col("l_tax")).alias("price_qty"))


@query("f18_correlated_pairs", _CORR_LONG + "SELECT b AS drop_feature, a AS corr_feature, round(corr, 6) AS corr_value FROM k WHERE abs(corr) > 0.8")
def correlated(spark, d):
    return P.correlated_pairs(_wide(spark, d), _WCOLS, 0.8).withColumn("corr_value", r("corr_value"))


@query("f19_correlated_families", _CORR_LONG + "SELECT string_split(b, '_')[1] AS family, count(*) AS n FROM k WHERE abs(corr) > 0.8 GROUP BY 1")
def families(spark, d):
    return P.correlated_families(_wide(spark, d), _WCOLS, 0.8)


@query("f21_vs_global", """
SELECT o_orderkey, CAST(o_totalprice >= (SELECT avg(o_totalprice) FROM orders) AS INTEGER) AS above_mean, CAST(o_totalprice >= (SELECT median(o_totalprice) FROM orders) AS INTEGER) AS above_median FROM orders""")
def vs_global(spark, d):
    orders = load(spark, d, "orders")
    return P.vs_global(P.vs_global(orders, "o_totalprice", "mean", "above_mean"), "o_totalprice", "median", "above_median").select("o_orderkey", "above_mean", "above_median")


@query("f22_melt", """
WITH m AS (SELECT l_returnflag, 'l_quantity' AS variable, l_quantity AS value FROM lineitem UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem)
SELECT l_returnflag, variable, count(value) AS n, round(avg(value), 6) AS mean FROM m GROUP BY 1, 2""")
def melt(spark, d):
    long = load(spark, d, "lineitem").unpivot(["l_returnflag"], ["l_quantity", "l_tax"], "variable", "value")
    return long.groupBy("l_returnflag", "variable").agg(F.count("value").alias("n"), r(F.avg("value")).alias("mean"))


@query("f23_mode", """
SELECT o_orderstatus, o_orderpriority, n FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n, row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) AS k FROM orders GROUP BY 1, 2) WHERE k = 1""")
def mode(spark, d):
    return mode_table(load(spark, d, "orders"), "o_orderpriority", ["o_orderstatus"])


@query("f24_class_balance", "SELECT quality, count(*) AS n, round(max(count(*)) OVER () / count(*), 6) AS ratio FROM labels GROUP BY 1")
def class_balance(spark, d):
    return P.class_balance(load(spark, d, "labels"), "quality").withColumn("ratio", r("ratio"))


@query("f25_rate_compare", """
SELECT round(avg(CAST(p >= 0.6 AS INTEGER)), 6) AS predicted_rate, round(avg(quality), 6) AS actual_rate
FROM (SELECT quality, (CAST('0x' || substr(md5('score:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000) / 1000.0 AS p FROM labels)""")
def rate_compare(spark, d):
    from ..functions.hashing import key_hash

    rows = load(spark, d, "labels").withColumn("p", (key_hash("doc_id", "score") % 1000) / 1000.0)
    return P.rate_compare(rows, "p", "quality", 0.6).select(r("predicted_rate").alias("predicted_rate"), r("actual_rate").alias("actual_rate"))


@query("f28_histogram", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, count(*) AS n, round(any_value(lo) + least(floor((o_totalprice - lo) * 20 / (hi - lo)), 19) * any_value(hi - lo) / 20, 4) AS low
FROM orders, s GROUP BY least(floor((o_totalprice - lo) * 20 / (hi - lo)), 19)""")
def histogram(spark, d):
    return P.histogram(load(spark, d, "orders"), "o_totalprice", bins=20).withColumn("low", r("low", 4))


@query("f28_histogram_width", "SELECT CAST(floor(o_totalprice / 25000) AS BIGINT) AS bin, count(*) AS n, CAST(floor(o_totalprice / 25000) * 25000 AS DOUBLE) AS low FROM orders GROUP BY floor(o_totalprice / 25000)")
def histogram_width(spark, d):
    return P.histogram(load(spark, d, "orders"), "o_totalprice", width=25000.0)


_POINTS = "p AS (SELECT CAST(epoch(ts) AS DOUBLE) AS x, value AS y FROM events), s AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)"


def _points(spark, d):
    return load(spark, d, "events").withColumn("x", F.unix_micros(F.to_timestamp("ts")) / 1e6)


@query("f29_raster", f"""
WITH {_POINTS} SELECT CAST(least(floor((x - x0) * 90 / (x1 - x0)), 89) AS INTEGER) AS px, CAST(least(floor((y - y0) * 30 / (y1 - y0)), 29) AS INTEGER) AS py, count(*) AS n FROM p, s GROUP BY 1, 2""")
def raster(spark, d):
    return P.raster(_points(spark, d), F.col("x"), F.col("value"), 90, 30)


@query("f29_line_raster", f"""
WITH {_POINTS} SELECT CAST(least(floor((x - x0) * 90 / (x1 - x0)), 89) AS INTEGER) AS px, min(y) AS low, max(y) AS high, min_by(y, x) AS first, max_by(y, x) AS last FROM p, s GROUP BY 1""")
def line_raster(spark, d):
    return P.line_raster(_points(spark, d), F.col("x"), "value", 90)


@query("f30_decimate", "SELECT event_id FROM events ORDER BY CAST('0x' || substr(md5('decimate:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT), event_id LIMIT 2000")
def decimate(spark, d):
    return P.decimate(load(spark, d, "events"), "event_id", 2000).select("event_id")


@query("f31_box_stats", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS q50, quantile_cont(o_totalprice, 0.75) AS q75 FROM orders GROUP BY 1)
SELECT o_orderpriority, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75, min(x) FILTER (WHERE i) AS whisker_low, max(x) FILTER (WHERE i) AS whisker_high, count(*) FILTER (WHERE NOT i) AS outliers
FROM (SELECT o_orderpriority, q25, q50, q75, o_totalprice AS x, o_totalprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS i FROM orders JOIN q USING (o_orderpriority)) GROUP BY 1, 2, 3, 4""")
def box_stats(spark, d):
    out = P.box_stats(load(spark, d, "orders"), "o_orderpriority", "o_totalprice")
    return out.select("o_orderpriority", *[r(c, 4).alias(c) for c in ("q25", "q50", "q75")], "whisker_low", "whisker_high", "outliers")


@query("j06_group_transform", "SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS m, max(o_totalprice) OVER (PARTITION BY o_custkey) AS x FROM orders")
def group_transform(spark, d):
    out = P.group_transform(load(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], m=F.avg("o_totalprice"), x=F.max("o_totalprice"))
    return out.select("o_orderkey", r("m", 8).alias("m"), "x")
