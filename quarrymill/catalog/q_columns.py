"""B: projections, filters, missing values, casts, type shrinking."""

from pyspark.sql import functions as F

from ..operators import columns as C
from .registry import load, query, r


@query("b01_select_assign", """
SELECT l_orderkey, l_linenumber, l_quantity AS quantity, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem""")
def select_assign(spark, d):
    line = load(spark, d, "lineitem").drop("l_shipdate").withColumnRenamed("l_quantity", "quantity")
    return line.withColumn("net", r(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)).select("l_orderkey", "l_linenumber", "quantity", "net")


@query("b02_filter", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (l_quantity > 40 OR l_discount >= 0.08) AND NOT (l_returnflag = 'N') AND l_tax IS NOT NULL""")
def row_filter(spark, d):
    mask = ((F.col("l_quantity") > 40) | (F.col("l_discount") >= 0.08)) & ~(F.col("l_returnflag") == "N") & F.col("l_tax").isNotNull()
    return load(spark, d, "lineitem").filter(mask).select("l_orderkey", "l_linenumber")


@query("b03_assign_where", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE round(o_totalprice, 4) END AS o_totalprice FROM orders""")
def assign_where(spark, d):
    out = C.assign_where(load(spark, d, "orders"), F.col("o_orderstatus") == "P", "o_totalprice", 0.0)
    return out.select("o_orderkey", r("o_totalprice", 4).alias("o_totalprice"))


def _holes(events):
    hole = F.col("event_id") % 7 == 0
    return events.select(
        "event_id",
        F.when(~hole, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 == 0, "None").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"),
    )


HOLES_SQL = """
WITH h AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
  CASE WHEN event_id % 5 = 0 THEN 'None' ELSE event_type END AS event_type,
  CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id FROM events) """


@query("b07_fill_missing", HOLES_SQL + """
SELECT event_id, round(coalesce(value, -1), 4) AS value, CASE WHEN event_type = 'None' OR event_type IS NULL THEN '-1' ELSE event_type END AS event_type,
  coalesce(user_id, -1) AS user_id FROM h""")
def fill_missing(spark, d):
    return C.fill_missing(_holes(load(spark, d, "events")), -1).withColumn("value", r("value", 4))


@query("b08_fill_mode", """
WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS p FROM orders),
m AS (SELECT p FROM h WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)
SELECT o_orderkey, coalesce(p, (SELECT p FROM m)) AS o_orderpriority FROM h""")
def fill_mode(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return C.fill_mode(orders, "o_orderpriority")


@query("b09_sentinel_to_null", """
SELECT l_orderkey, l_linenumber, nullif(l_quantity, 50) AS l_quantity FROM lineitem""")
def sentinel(spark, d):
    return C.sentinel_to_null(load(spark, d, "lineitem"), "quantity", 50).select("l_orderkey", "l_linenumber", "l_quantity")


@query("b10_drop_low_information", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def low_information(spark, d):
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    padded = line.withColumn("constant", F.lit(80)).withColumn("empty", F.lit(None).cast("string"))
    return C.drop_low_information(padded)


HASH32 = "CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


@query("b11_hash_sample", f"""
SELECT l_orderkey, l_linenumber FROM (SELECT *, l_orderkey * 10 + l_linenumber AS k FROM lineitem)
WHERE {HASH32.format(seed='sample', key='k')} / 4294967296.0 < 0.1""")
def hash_sample(spark, d):
    line = load(spark, d, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return C.hash_sample(line, "k", 0.1).select("l_orderkey", "l_linenumber")


@query("b13_cast", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
  CAST(l_linenumber > 0 AS INTEGER) AS flag FROM lineitem""")
def cast(spark, d):
    line = load(spark, d, "lineitem").withColumn("flag", F.col("l_linenumber"))
    out = C.cast_columns(line, {"l_quantity": "int", "l_shipdate": "date", "flag": "boolean"})
    return out.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("string").alias("l_shipdate"), F.col("flag").cast("int").alias("flag"))


NUMS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query("b14_compress_dtypes", """
WITH m AS (SELECT max(l_orderkey) AS a, max(l_linenumber) AS b FROM lineitem),
t AS (SELECT unnest(['l_orderkey', 'l_linenumber', 'l_quantity', 'l_extendedprice']) AS feature)
SELECT feature, CASE feature WHEN 'l_orderkey' THEN (CASE WHEN a <= 32767 THEN 'smallint' WHEN a <= 2147483647 THEN 'int' ELSE 'bigint' END)
  WHEN 'l_linenumber' THEN 'smallint' ELSE 'float' END AS new_type, n FROM t, m, (SELECT count(*) AS n FROM lineitem)""")
def compress(spark, d):
    small = C.compress_dtypes(load(spark, d, "lineitem").select(*NUMS))
    kinds = {f.name: f.dataType.simpleString() for f in small.schema.fields}
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(t).alias("new_type")) for c, t in kinds.items()])
    # counting the narrowed columns proves that every value survived the cast
    alive = F.least(*[F.count(c) for c in NUMS])
    return small.agg(alive.alias("n")).select(F.explode(rows).alias("x"), "n").select("x.*", "n")


@query("b15_reduce_mem_usage", """
WITH m AS (SELECT max(l_orderkey) AS a FROM lineitem), t AS (SELECT unnest(['l_orderkey', 'l_linenumber', 'l_quantity', 'l_extendedprice']) AS feature)
SELECT feature, CASE feature WHEN 'l_orderkey' THEN (CASE WHEN a < 127 THEN 'tinyint' WHEN a < 32767 THEN 'smallint' WHEN a < 2147483647 THEN 'int' ELSE 'bigint' END)
  WHEN 'l_linenumber' THEN 'tinyint' WHEN 'l_extendedprice' THEN 'double' ELSE 'float' END AS new_type, n
FROM t, m, (SELECT count(*) AS n FROM lineitem)""")
def reduce_mem(spark, d):
    small = C.reduce_mem_usage(load(spark, d, "lineitem").select(*NUMS), skip="extended")
    kinds = {f.name: f.dataType.simpleString() for f in small.schema.fields}
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(t).alias("new_type")) for c, t in kinds.items()])
    alive = F.least(*[F.count(c) for c in NUMS])
    return small.agg(alive.alias("n")).select(F.explode(rows).alias("x"), "n").select("x.*", "n")


@query("b16_dtype_report", """
WITH n AS (SELECT count(*) AS n, max(o_orderkey) AS k, max(o_custkey) AS c, count(DISTINCT o_orderstatus) AS s, count(DISTINCT o_orderpriority) AS p FROM orders)
SELECT 'o_orderkey' AS feature, 'bigint' AS old_type, CASE WHEN k < 127 THEN 'tinyint' WHEN k < 32767 THEN 'smallint' WHEN k < 2147483647 THEN 'int' ELSE 'bigint' END AS new_type FROM n
UNION ALL SELECT 'o_custkey', 'bigint', CASE WHEN c < 127 THEN 'tinyint' WHEN c < 32767 THEN 'smallint' WHEN c < 2147483647 THEN 'int' ELSE 'bigint' END FROM n
UNION ALL SELECT 'o_totalprice', 'double', 'float'
UNION ALL SELECT 'o_orderstatus', 'string', CASE WHEN s / n < 0.5 THEN 'category' ELSE 'string' END FROM n
UNION ALL SELECT 'o_orderpriority', 'string', CASE WHEN p / n < 0.5 THEN 'category' ELSE 'string' END FROM n""")
def dtype_report(spark, d):
    return C.dtype_report(load(spark, d, "orders").drop("o_orderdate"))


@query("b17_nonzero_columns", """
SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity > 30 AND l_orderkey > 0""")
def nonzero(spark, d):
    line = load(spark, d, "lineitem")
    mask = (F.col("l_quantity") > 30) & (F.col("l_orderkey") > 0)
    return C.nonzero_columns(line, mask, ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
