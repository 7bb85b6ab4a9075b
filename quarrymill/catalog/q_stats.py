"""Q: distribution tests and mining."""

from pyspark.sql import functions as F

from ..operators import stats as S
from ..operators.encoding import to_items
from .registry import load, query, r


@query("q01_ks_2samp", """
WITH v AS (SELECT 'o_totalprice' AS feature, CAST(o_totalprice AS DOUBLE) AS v, o_orderkey % 2 AS h FROM orders UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE), o_orderkey % 2 FROM orders),
c AS (SELECT feature, v, count(*) FILTER (WHERE h = 0) AS a, count(*) FILTER (WHERE h = 1) AS b FROM v GROUP BY 1, 2),
w AS (SELECT feature, abs(sum(a) OVER (PARTITION BY feature ORDER BY v) / sum(a) OVER (PARTITION BY feature) - sum(b) OVER (PARTITION BY feature ORDER BY v) / sum(b) OVER (PARTITION BY feature)) AS gap FROM c)
SELECT feature, round(max(gap), 6) AS statistic FROM w GROUP BY 1""")
def ks(spark, d):
    orders = load(spark, d, "orders")
    out = S.ks_2samp(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1"), ["o_totalprice", "o_custkey"])
    return out.select("feature", r("statistic").alias("statistic"))


@query("q01_ks_pvalue")
def ks_pvalue(spark, d):
    orders = load(spark, d, "orders")
    out = S.ks_2samp(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1"), ["o_totalprice", "o_custkey"])
    return out.select("feature", r("pvalue", 4).alias("pvalue")).orderBy("pvalue")


@query("q02_ks_normal")
def ks_normal(spark, d):
    line = load(spark, d, "lineitem")
    return S.ks_normal(line.withColumn("z", (F.col("l_quantity") - 25) / 15), "z").select(r("statistic", 4).alias("statistic"), r("pvalue", 4).alias("pvalue"))


@query("q03_boxcox", """
WITH g AS (SELECT CAST(i AS DOUBLE) / 10 AS lam FROM range(-5, 16) x(i) WHERE i <> 0), z AS (SELECT lam, o_totalprice AS x, (o_totalprice ** lam - 1) / lam AS z FROM orders, g WHERE o_totalprice > 0),
s AS (SELECT lam, -count(*) / 2 * ln(var_pop(z)) + (lam - 1) * sum(ln(x)) AS l FROM z GROUP BY 1), b AS (SELECT lam FROM s ORDER BY l DESC LIMIT 1)
SELECT o_orderkey, lam, round((o_totalprice ** lam - 1) / lam, 3) AS z FROM orders, b""")
def boxcox(spark, d):
    orders = load(spark, d, "orders")
    lam = S.boxcox_lambda(orders, "o_totalprice", [i / 10 for i in range(-5, 16) if i])
    return S.boxcox(orders, "o_totalprice", lam, "z").select("o_orderkey", F.lit(lam).alias("lam"), r("z", 3).alias("z"))


@query("q03_boxcox_fitted")
def boxcox_fitted(spark, d):
    return S.boxcox(load(spark, d, "orders"), "o_totalprice", name="z").select("o_orderkey", r("z", 1).alias("z"))


def _baskets(spark, d):
    line = load(spark, d, "lineitem")
    flags = line.withColumn("half", F.when(F.col("l_quantity") > 25, "high").otherwise("low")).withColumn("bulk", F.when(F.col("l_quantity") > 30, "yes").otherwise("no"))
    return to_items(flags, ["l_returnflag", "half", "bulk"])


@query("q04_pair_rules", """
WITH i AS (SELECT row_number() OVER () AS k, 'l_returnflag:' || l_returnflag AS a, 'half:' || CASE WHEN l_quantity > 25 THEN 'high' ELSE 'low' END AS b, 'bulk:' || CASE WHEN l_quantity > 30 THEN 'yes' ELSE 'no' END AS c FROM lineitem),
u AS (SELECT k, unnest([a, b, c]) AS item FROM i), n AS (SELECT count(*) AS n FROM i), s AS (SELECT item, count(*) AS c FROM u GROUP BY 1),
p AS (SELECT x.item AS x, y.item AS y, count(*) AS c FROM u x JOIN u y ON x.k = y.k AND x.item <> y.item GROUP BY 1, 2)
SELECT x AS antecedent, y AS consequent, round(p.c / n, 6) AS support, round(p.c / sx.c, 6) AS confidence, round(p.c * n / (sx.c * sy.c), 6) AS lift
FROM p, n, s sx, s sy WHERE sx.item = x AND sy.item = y AND p.c / n >= 0.2 AND sx.c / n >= 0.2 AND sy.c / n >= 0.2 AND p.c / sx.c >= 0.8 AND p.c * n / (sx.c * sy.c) >= 1.5""")
def pair_rules(spark, d):
    out = S.pair_rules(_baskets(spark, d), "items", 0.2, 0.8, 1.5)
    return out.select("antecedent", "consequent", *[r(c).alias(c) for c in ("support", "confidence", "lift")])


@query("q04_association_rules")
def rules(spark, d):
    out = S.association_rules(_baskets(spark, d), "items", 0.1, 0.6, 1.5)
    return out.select(F.array_join(F.array_sort("antecedent"), "|").alias("antecedent"), F.array_join("consequent", "|").alias("consequent"), *[r(c).alias(c) for c in ("support", "confidence", "lift")])
