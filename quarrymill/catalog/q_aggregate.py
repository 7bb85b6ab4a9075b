"""F: group statistics, recipes, stores."""

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators.synth import Relation, deep_features
from ..operators.reject import band_rates, reject_inference
from .registry import load, query, r


def rounded(df, keys, digits=4):
    return df.select(*keys, *[(F.col(c) if dict(df.dtypes)[c] in ("bigint", "string", "int") else r(c, digits)).alias(c) for c in df.columns if c not in keys])


@query("f01_group_agg", """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean, round(sum(l_quantity), 2) AS sum, count(l_quantity) AS count, max(l_quantity) AS max, min(l_quantity) AS min,
 round(stddev_samp(l_quantity), 6) AS std, round(var_samp(l_quantity), 6) AS var FROM lineitem GROUP BY 1, 2""")
def group_agg(spark, d):
    out = A.group_agg(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], [("l_quantity", f) for f in ("mean", "sum", "count", "max", "min", "std", "var")], names=lambda c, f: f)
    return rounded(out, ["l_returnflag", "l_linestatus"], 6).withColumn("sum", r("sum", 2))


@query("f02_order_statistics", """
SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.99) - quantile_cont(l_extendedprice, 0.01), 4) AS q_range, round(skewness(l_extendedprice), 6) AS skew,
 round(median(l_extendedprice), 4) AS median, round(max(l_extendedprice) - min(l_extendedprice), 4) AS range FROM lineitem GROUP BY 1""")
def order_statistics(spark, d):
    out = A.group_agg(load(spark, d, "lineitem"), ["l_suppkey"], [("l_extendedprice", f) for f in ("q_range", "skew", "median", "range")], names=lambda c, f: f)
    return out.select("l_suppkey", r("q_range", 4).alias("q_range"), r("skew", 6).alias("skew"), r("median", 4).alias("median"), r("range", 4).alias("range"))


@query("f03_recipes", """
SELECT event_type, round(avg(value), 6) AS event_type_value_mean, round(sum(value), 3) AS event_type_value_sum, count(value) AS event_type_value_count,
 round(median(value), 4) AS event_type_value_median, round(quantile_cont(value, 0.75), 4) AS event_type_value_q75, round(sqrt(sum(value * value)), 5) AS event_type_value_norm FROM events GROUP BY 1""")
def recipes(spark, d):
    rec = A.recipe(["event_type"], [("value", f) for f in ("mean", "sum", "count", "median", "q75")] + [("value", ("norm", lambda c: F.sqrt(F.sum(c * c))))])
    out = A.group_agg(load(spark, d, "events"), rec.keys, rec.specs)
    n = "event_type_value_"
    return out.select("event_type", r(n + "mean").alias(n + "mean"), r(n + "sum", 3).alias(n + "sum"), n + "count", r(n + "median", 4).alias(n + "median"), r(n + "q75", 4).alias(n + "q75"), r(n + "norm", 5).alias(n + "norm"))


@query("f04_group_stats", """
WITH tr AS (SELECT * FROM events WHERE event_id % 2 = 0 AND event_type <> 'error'), ap AS (SELECT *, CAST(ts AS DATE) AS day FROM events WHERE event_id % 2 = 1),
s AS (SELECT event_type, avg(value) AS m, coalesce(skewness(value), 0) AS k, count(value) AS c FROM tr GROUP BY 1), g AS (SELECT day, median(value) AS md FROM ap GROUP BY 1)
SELECT event_id, round(m, 6) AS event_type_value_mean, round(k, 6) AS event_type_value_skew, CAST(c AS DOUBLE) AS event_type_value_count, round(md, 6) AS day_value_median,
 round(value / (m + 1), 6) AS event_type_value_mean_neutral, round(value / (k + 1), 6) AS event_type_value_skew_neutral, round(value / (md + 1), 6) AS day_value_median_neutral
FROM ap LEFT JOIN s USING (event_type) LEFT JOIN g USING (day)""")
def group_stats(spark, d):
    events = load(spark, d, "events").withColumn("day", F.to_date("ts"))
    store = A.GroupStats([A.recipe(["event_type"], [("value", "mean"), ("value", "skew"), ("value", "count")]), A.recipe(["day"], [("value", "median")])], live_key="day")
    store.fit(events.filter("event_id % 2 = 0 AND event_type <> 'error'"))
    out = store.transform(events.filter("event_id % 2 = 1"), salt_on=["event_id"])
    return out.select("event_id", *[r(c).alias(c) for c in out.columns if c.startswith(("event_type_", "day_"))])


@query("f05_neutral_ratio", """
WITH s AS (SELECT o_orderpriority, max(o_totalprice) AS m FROM orders GROUP BY 1)
SELECT o_orderkey, round(o_totalprice / (m + 1), 8) AS ratio FROM orders JOIN s USING (o_orderpriority)""")
def neutral(spark, d):
    orders = load(spark, d, "orders")
    out = A.GroupStats([A.recipe(["o_orderpriority"], [("o_totalprice", "max")])]).fit(orders).transform(orders, salt_on=["o_orderkey"])
    return out.select("o_orderkey", r("o_orderpriority_o_totalprice_max_neutral", 8).alias("ratio"))


@query("f06_side_table", """
WITH s AS (SELECT l_orderkey, avg(l_quantity) AS m, sum(l_extendedprice) AS t, count(l_quantity) AS c FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(m, 6) AS l_orderkey_l_quantity_mean, round(t, 3) AS l_orderkey_l_extendedprice_sum, c AS l_orderkey_l_quantity_count FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def side_table(spark, d):
    orders, line = load(spark, d, "orders", "lineitem")
    out = A.GroupStatsMerge("l_orderkey", [("l_quantity", "mean"), ("l_extendedprice", "sum"), ("l_quantity", "count")]).fit(line).transform(orders, "o_orderkey")
    return out.select("o_orderkey", r("l_orderkey_l_quantity_mean").alias("l_orderkey_l_quantity_mean"), r("l_orderkey_l_extendedprice_sum", 3).alias("l_orderkey_l_extendedprice_sum"), "l_orderkey_l_quantity_count")


@query("f20_vs_group_mean", """
SELECT o_orderkey, round(o_totalprice / avg(o_totalprice) OVER (PARTITION BY o_orderpriority, o_orderstatus) - 1, 6) AS vs FROM orders""")
def vs_group(spark, d):
    return A.vs_group_mean(load(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice", "vs", ["o_orderkey"]).select("o_orderkey", r("vs").alias("vs"))


SCORE = "(CAST('0x' || substr(md5('score:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000) / 1000.0"
REJECT_SQL = f"""
WITH s AS (SELECT doc_id, {SCORE} AS score FROM documents), lab AS (SELECT doc_id, score, toxic FROM s JOIN labels USING (doc_id)),
e AS (SELECT quantile_cont(score, [0.2, 0.4, 0.6, 0.8]) AS e FROM lab),
b AS (SELECT s.doc_id, s.score, toxic, CASE WHEN s.score <= e[1] THEN 0 WHEN s.score <= e[2] THEN 1 WHEN s.score <= e[3] THEN 2 WHEN s.score <= e[4] THEN 3 ELSE 4 END AS band
 FROM s LEFT JOIN labels USING (doc_id), e)
"""


def _scored(spark, d):
    from ..functions.hashing import key_hash

    docs, labels = load(spark, d, "documents", "labels")
    return docs.select("doc_id", ((key_hash("doc_id", "score") % 1000) / 1000.0).alias("score")).join(labels, "doc_id", "left")


@query("f26_band_rates", REJECT_SQL + "SELECT band, count(*) AS n, round(avg(toxic), 6) AS bad_rate FROM b WHERE toxic IS NOT NULL GROUP BY 1")
def bands(spark, d):
    labelled = _scored(spark, d).filter("toxic IS NOT NULL")
    return band_rates(labelled, "score", "toxic", 5).withColumn("bad_rate", r("bad_rate"))


@query("f26_reject_inference", REJECT_SQL + """
, g AS (SELECT band, avg(toxic) AS bad FROM b WHERE toxic IS NOT NULL GROUP BY 1)
SELECT doc_id, round(score, 4) AS score, toxic, 0 AS inferred FROM b WHERE toxic IS NOT NULL UNION ALL
SELECT doc_id, round(score, 4), CAST(CAST('0x' || substr(md5('reject:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < bad * 2 AS INTEGER), 1 FROM b JOIN g USING (band) WHERE toxic IS NULL""")
def rejects(spark, d):
    rows = _scored(spark, d)
    out = reject_inference(rows.filter("toxic IS NOT NULL"), rows.filter("toxic IS NULL"), "doc_id", "score", "toxic", bands=5, factor=2.0)
    return out.withColumn("score", r("score", 4))


@query("f27_deep_features", """
WITH l AS (SELECT l_orderkey, sum(l_quantity) AS sq, avg(l_quantity) AS mq, max(l_quantity) AS xq, min(l_quantity) AS nq, stddev_samp(l_quantity) AS dq, count(*) AS c,
  count(DISTINCT l_returnflag) AS u FROM lineitem GROUP BY 1),
mo AS (SELECT l_orderkey, l_returnflag AS mode FROM (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, l_returnflag) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1),
o AS (SELECT o_custkey, o_orderstatus, sq, mq, xq, nq, dq, c, u, mode FROM orders LEFT JOIN l ON o_orderkey = l.l_orderkey LEFT JOIN mo ON o_orderkey = mo.l_orderkey)
SELECT c_custkey, n AS count__orders, round(a, 3) AS sum__orders__sum__lineitem__l_quantity, round(b, 8) AS mean__orders__mean__lineitem__l_quantity, round(g, 3) AS max__orders__max__lineitem__l_quantity,
 round(h, 8) AS mean__orders__std__lineitem__l_quantity, round(sk, 8) AS skew__orders__count__lineitem, w AS nunique__orders__mode__lineitem__l_returnflag, z AS nunique__orders__o_orderstatus
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, coalesce(sum(sq), 0) AS a, avg(mq) AS b, max(xq) AS g, avg(dq) AS h, CASE WHEN count(c) >= 3 AND var_pop(c) > 0 THEN skewness(c) END AS sk,
  count(DISTINCT mode) AS w, count(DISTINCT o_orderstatus) AS z FROM o GROUP BY 1) ON c_custkey = o_custkey""")
def deep(spark, d):
    cust, orders, line = load(spark, d, "customer", "orders", "lineitem")
    entities = {
        "customer": cust.select("c_custkey"),
        "orders": orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
        "lineitem": line.select("l_orderkey", "l_quantity", "l_returnflag"),
    }
    relations = [Relation("customer", "c_custkey", "orders", "o_custkey"), Relation("orders", "o_orderkey", "lineitem", "l_orderkey")]
    out = deep_features(entities, relations, "customer")
    picks = {
        "sum__orders__sum__lineitem__l_quantity": 3, "mean__orders__mean__lineitem__l_quantity": 8, "max__orders__max__lineitem__l_quantity": 3,
        "mean__orders__std__lineitem__l_quantity": 8, "skew__orders__count__lineitem": 8,
    }
    return out.select("c_custkey", "count__orders", "nunique__orders__mode__lineitem__l_returnflag", "nunique__orders__o_orderstatus", *[r(c, k).alias(c) for c, k in picks.items()])


@query("j04_pct_of_group", "SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_orderstatus) * 100, 8) AS pct FROM orders")
def pct(spark, d):
    return A.pct_of_group(load(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", "pct", ["o_orderkey"]).select("o_orderkey", r("pct", 8).alias("pct"))


@query("j05_spread_scale", """
SELECT o_orderkey, round(o_totalprice / (max(o_totalprice) OVER (PARTITION BY o_orderpriority) - min(o_totalprice) OVER (PARTITION BY o_orderpriority)), 6) AS scaled FROM orders""")
def spread(spark, d):
    return A.spread_scale(load(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", "scaled", ["o_orderkey"]).select("o_orderkey", r("scaled").alias("scaled"))
