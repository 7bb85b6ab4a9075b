"""C: row-wise numeric features."""

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import scaling as S
from .registry import load, query, r

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber"]


@query("c01_row_stats", """
WITH b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS a, l_discount AS b, l_tax AS c FROM lineitem),
l AS (SELECT *, list_filter([a, b, c], lambda x: x IS NOT NULL) AS v FROM b)
SELECT l_orderkey, l_linenumber, round(list_sum(v), 6) AS f_sum, round(list_avg(v), 6) AS f_mean, round(list_var_pop(v), 6) AS f_var,
  list_min(v) AS f_min, list_max(v) AS f_max FROM l""")
def row_stats(spark, d):
    line = load(spark, d, "lineitem").select(*KEYS, F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("a"), F.col("l_discount").alias("b"), F.col("l_tax").alias("c"))
    out = N.row_stats(line, ["a", "b", "c"], "f")
    return out.select(*KEYS, *[r(f"f_{s}").alias(f"f_{s}") for s in ("sum", "mean", "var", "min", "max")])


@query("c03_ratio_plus1", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / (l_quantity + 1), 8) AS ratio FROM lineitem")
def ratio_plus1(spark, d):
    return load(spark, d, "lineitem").select(*KEYS, r(N.ratio_plus1("l_extendedprice", "l_quantity"), 8).alias("ratio"))


@query("c04_safe_ratio", """
SELECT o_orderkey, round(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_totalprice / (o_custkey % 10) END, 8) AS ratio,
  round(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_totalprice / (o_custkey % 10) END / 60.0, 8) AS per_hour FROM orders""")
def safe_ratio(spark, d):
    orders = load(spark, d, "orders").withColumn("m", F.col("o_custkey") % 10)
    return orders.select("o_orderkey", r(N.safe_ratio("o_totalprice", "m"), 8).alias("ratio"), r(N.per_hour("o_totalprice", "m"), 8).alias("per_hour"))


@query("c05_net_features", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS pa, l_extendedprice * l_discount AS pr, l_quantity AS qa, l_tax AS qr, l_tax * 2 AS xa FROM lineitem)
SELECT l_orderkey, l_linenumber, round(pa - pr, 4) AS price_net, round(pr / (pa + 1), 6) AS price_use_rate, round(qa - qr, 4) AS stock_net,
  round(qr / (qa + 1), 6) AS stock_use_rate, round(pa + qa + xa, 4) AS total_gain, round(pr + qr, 4) AS total_loss, round(pa + qa + xa - (pr + qr), 4) AS total_net FROM b""")
def net_features(spark, d):
    line = load(spark, d, "lineitem").select(
        *KEYS,
        F.col("l_extendedprice").alias("price_add_value"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("price_reduce_value"),
        F.col("l_quantity").alias("stock_add_value"),
        F.col("l_tax").alias("stock_reduce_value"),
        (F.col("l_tax") * 2).alias("extra_add_value"),
    )
    out = line.select(*KEYS, *N.net_features(line.columns))
    return out.select(*KEYS, *[r(c, 6 if c.endswith("rate") else 4).alias(c) for c in out.columns if c not in KEYS])


@query("c06_interactions", """
SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount, round(l_quantity / (l_discount + 1), 6) AS l_quantity_per_l_discount,
  round(sqrt(l_quantity * l_discount), 6) AS sqrt_l_quantity_x_l_discount FROM lineitem""")
def interactions(spark, d):
    out = load(spark, d, "lineitem").select(*KEYS, *N.interactions([("l_quantity", "l_discount")]))
    return out.select(*KEYS, *[r(c).alias(c) for c in out.columns if c not in KEYS])


@query("c07_log_features", """
SELECT o_orderkey, round(CASE WHEN o_totalprice > 0 THEN ln(o_totalprice) END, 6) AS o_totalprice_ln, round(CASE WHEN o_totalprice > 0 THEN log10(o_totalprice) END, 6) AS o_totalprice_log10,
  round(ln(1 + o_totalprice), 6) AS o_totalprice_log1p, round(o_totalprice, 2) AS o_totalprice_back FROM orders""")
def log_features(spark, d):
    out = load(spark, d, "orders").select("o_orderkey", *N.log_features(["o_totalprice"]))
    return out.select("o_orderkey", *[r(c, 2 if c.endswith("back") else 6).alias(c) for c in out.columns[1:]])


@query("c08_minmax_sum", """
WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b, min(o_custkey) AS c, max(o_custkey) AS d FROM orders)
SELECT o_orderkey, round((o_totalprice - a) / (b - a) + (o_custkey - c) / (d - c), 6) AS score FROM orders, s""")
def minmax_sum(spark, d):
    return S.minmax_sum(load(spark, d, "orders"), ["o_totalprice", "o_custkey"]).select("o_orderkey", r("score").alias("score"))


@query("c09_standard_scale", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM orders, s""")
def standard_scale(spark, d):
    return S.standard_scale(load(spark, d, "orders"), ["o_totalprice"]).select("o_orderkey", r("o_totalprice_std").alias("z"))


@query("c10_flags", """
SELECT event_id, CAST(value > 2 AS INTEGER) AS active, CAST(value >= (SELECT quantile_cont(value, 0.5) FROM events) AS INTEGER) AS above FROM events""")
def flags(spark, d):
    from ..operators.profile import vs_global

    events = load(spark, d, "events").withColumn("active", (F.col("value") > 2).cast("int"))
    return vs_global(events, "value", "median").select("event_id", "active", "above")


@query("c11_row_mean", "SELECT l_orderkey, l_linenumber, round((l_quantity + l_discount + l_tax) / 3, 6) AS mean, round(l_quantity + l_discount + l_tax, 6) AS total FROM lineitem")
def row_mean(spark, d):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return load(spark, d, "lineitem").select(*KEYS, r(N.row_mean(cols)).alias("mean"), r(N.row_sum(cols)).alias("total"))


@query("c12_future_target", """
SELECT o_custkey, round(sum(o_totalprice) - coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01'), 0), 2) AS future FROM orders GROUP BY 1""")
def future_target(spark, d):
    early = F.coalesce(F.sum(F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.col("o_totalprice"))), F.lit(0.0))
    sums = load(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("later"), early.alias("early"))
    return sums.select("o_custkey", r(N.future_target("later", "early"), 2).alias("future"))


@query("c13_finalize_prediction", "SELECT c_custkey, round(greatest(c_acctbal, 0) + c_nationkey, 4) AS prediction FROM customer")
def finalize(spark, d):
    return load(spark, d, "customer").select("c_custkey", r(N.finalize_prediction("c_acctbal", F.col("c_nationkey").cast("double")), 4).alias("prediction"))


@query("c14_recode", """
SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber WHEN 1 THEN 12 WHEN 2 THEN 16 WHEN 3 THEN 18 ELSE 20 END AS DOUBLE) AS years FROM lineitem""")
def recode(spark, d):
    return load(spark, d, "lineitem").select(*KEYS, N.recode("l_linenumber", {1: 12.0, 2: 16.0, 3: 18.0}, default=20.0).alias("years"))


@query("c15_mask_predictions", """
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE round(o_totalprice, 4) END AS p FROM orders""")
def mask_predictions(spark, d):
    orders = load(spark, d, "orders")
    flags = orders.select("o_orderkey", (F.col("o_custkey") % 3 != 0).cast("int").alias("flag"))
    return S.mask_predictions(orders.withColumn("p", r("o_totalprice", 4)), flags, "o_orderkey", "p", "flag").select("o_orderkey", "p")


@query("c16_residual", """
WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, round(l_extendedprice - (a * l_quantity + b), 3) AS residual FROM lineitem, s""")
def residual(spark, d):
    return S.residual_feature(load(spark, d, "lineitem"), "l_extendedprice", "l_quantity").select(*KEYS, r("residual", 3).alias("residual"))


@query("c16_residual_by_group", """
WITH s AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(l_extendedprice - (a * l_quantity + b), 3) AS residual FROM lineitem JOIN s USING (l_returnflag)""")
def residual_by_group(spark, d):
    out = S.residual_feature(load(spark, d, "lineitem"), "l_extendedprice", "l_quantity", ["l_returnflag"])
    return out.select(*KEYS, r("residual", 3).alias("residual"))


@query("c16_residual_by_model")
def residual_by_model(spark, d):
    line = load(spark, d, "lineitem").select(*KEYS, *LINE)
    return S.residual_by_model(line, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"]).select(*KEYS, r("residual", 2).alias("residual"))


@query("c17_minmax_fit_apply", """
WITH h AS (SELECT o_orderkey, o_orderkey % 2 AS half, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS x FROM orders),
s AS (SELECT min(coalesce(x, 0)) AS a, max(coalesce(x, 0)) AS b FROM h WHERE half = 0)
SELECT o_orderkey, round((coalesce(x, 0) - a) / (b - a), 6) AS x FROM h, s WHERE half = 1""")
def minmax_fit(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("x"))
    scaler = S.MinMax(["x"]).fit(orders.filter("o_orderkey % 2 = 0"))
    return scaler.transform(orders.filter("o_orderkey % 2 = 1")).select("o_orderkey", r("x").alias("x"))
