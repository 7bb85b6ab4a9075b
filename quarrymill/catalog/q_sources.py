"""A: scans, sinks and page parsing. Round trips write under the shared folder and read back."""

from pyspark.sql import functions as F

from ..operators.encoding import build_feature_index, encode_rows, field_offsets
from ..plans.scalars import Scalars
from ..plans.session import scratch_path
from ..sources import pages as P
from ..sources import readers as R
from ..sources import writers as S
from .registry import load, query, r

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@query("a01_csv_scan", """
SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders""")
def csv_scan(spark, d):
    orders = load(spark, d, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.option("header", True).option("timestampNTZFormat", STAMP).csv(path)
    back = R.read_csv(spark, path, orders.schema, ["o_orderkey", "o_totalprice", "o_orderdate"], timestamp_format=STAMP)
    return back.select("o_orderkey", r("o_totalprice", 4).alias("o_totalprice"), F.col("o_orderdate").cast("string").alias("o_orderdate"))


@query("a02_tsv_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def tsv_scan(spark, d):
    nation = load(spark, d, "nation")
    path = S.write_delimited(nation, scratch_path(spark, "nation-tsv"), sep="\t")
    return R.read_tsv(spark, f"{path}/part-*", nation.schema)


@query("a03_parquet_scan", "SELECT l_orderkey, l_linenumber, round(l_quantity, 4) AS l_quantity FROM lineitem")
def parquet_scan(spark, d):
    line = R.read_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])
    path = S.write_parquet(line, scratch_path(spark, "lineitem"))
    return R.read_parquet(spark, path).withColumn("l_quantity", r("l_quantity", 4))


@query("a04_read_frame", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def read_frame(spark, d):
    return R.read_frame(spark, f"{d}/orders.parquet").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("a06_checkpoint_table", "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY 1")
def checkpoint_table(spark, d):
    back = S.checkpoint_table(load(spark, d, "customer"), "customer")
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), r(F.sum("c_acctbal"), 2).alias("bal"))


@query("a07_annotations", """
WITH q AS (SELECT a.conv_id * 1000 + a.turn AS id, a.text AS t, b.text AS nxt, c.text AS prv FROM conversations a
  LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 LEFT JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.turn - 1 WHERE a.role = 'user')
SELECT id, 'chat' AS source, 0 AS pos, t AS question, coalesce(nxt, prv) AS answer FROM q WHERE nxt IS NOT NULL OR prv IS NOT NULL
UNION ALL SELECT id, 'chat', 1, t, prv FROM q WHERE nxt IS NOT NULL AND prv IS NOT NULL""")
def annotations(spark, d):
    conv = load(spark, d, "conversations")
    after = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("nxt"))
    before = conv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prv"))
    asked = conv.filter("role = 'user'").join(after, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
    answers = F.transform(F.array_compact(F.array("nxt", "prv")), lambda a: F.struct(F.col("text").alias("Q"), a.alias("A")))
    docs = asked.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text"), answers.alias("annotations"), F.lit("chat").alias("source"))
    path = scratch_path(spark, "annotations")
    docs.write.json(path)
    return R.read_annotations(spark, path).select("id", "source", "pos", "question", "answer")


@query("a08_pair_lines", """
WITH l AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\r?\\n'), lambda x: trim(x) <> '') AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(0, len(ls) // 2)) AS pair FROM l)
SELECT doc_id, CAST(pair AS INTEGER) AS pair, ls[pair * 2 + 1] AS part0, ls[pair * 2 + 2] AS part1 FROM p""")
def pair_lines(spark, d):
    return R.pair_lines(load(spark, d, "documents"), "doc_id", "text")


@query("a08_line_triples", """
WITH l AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\r?\\n'), lambda x: trim(x) <> '') AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(0, len(ls) // 3)) AS pair FROM l)
SELECT doc_id, CAST(pair AS INTEGER) AS pair, ls[pair * 3 + 1] AS part0, ls[pair * 3 + 3] AS part2 FROM p""")
def line_triples(spark, d):
    return R.pair_lines(load(spark, d, "documents"), "doc_id", "text", period=3, keep=(0, 2))


FIELDS = ["o_orderstatus", "o_orderpriority"]
INDEX_SQL = """
WITH c AS (SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 2),
p AS (SELECT DISTINCT field, CASE WHEN n / (SELECT count(*) FROM orders) < 0.001 THEN 'others' ELSE value END AS value FROM c),
ix AS (SELECT field, value, field || ':' || value AS feature, row_number() OVER (ORDER BY field || ':' || value) - 1 AS idx FROM p)
"""


def _index(spark, d):
    orders = load(spark, d, "orders")
    return orders, build_feature_index(orders, FIELDS)


LIBSVM_SQL = INDEX_SQL + """
, e AS (SELECT o_orderkey, idx FROM orders JOIN ix ON (field = 'o_orderstatus' AND value = o_orderstatus) OR (field = 'o_orderpriority' AND value = o_orderpriority))
"""


@query("a09_libsvm_write", LIBSVM_SQL + """
SELECT CAST(o_orderstatus = 'F' AS INTEGER) || ' ' || string_agg(idx || ':1', ' ' ORDER BY idx) AS line, count(*) OVER () AS total
FROM e JOIN orders USING (o_orderkey) GROUP BY o_orderkey, o_orderstatus""")
def libsvm_write(spark, d):
    orders, index = _index(spark, d)
    rows = encode_rows(orders, "o_orderkey", index, FIELDS).join(orders, "o_orderkey")
    path = S.write_libsvm(rows.withColumn("label", (F.col("o_orderstatus") == "F").cast("int")), scratch_path(spark, "libsvm"), "label", "indices")
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.withColumn("total", Scalars(lines, n=F.count(F.lit(1)))["n"])


@query("a10_libsvm_read", LIBSVM_SQL + """
SELECT CAST(o_orderstatus = 'F' AS DOUBLE) AS label, idx, CAST(count(*) AS DOUBLE) AS total FROM e JOIN orders USING (o_orderkey) GROUP BY 1, 2""")
def libsvm_read(spark, d):
    orders, index = _index(spark, d)
    rows = encode_rows(orders, "o_orderkey", index, FIELDS).join(orders, "o_orderkey")
    path = S.write_libsvm(rows.withColumn("label", (F.col("o_orderstatus") == "F").cast("int")), scratch_path(spark, "libsvm"), "label", "indices")
    back = R.read_libsvm(spark, path, dim=1000).select("label", F.explode("entries").alias("e"))
    return back.groupBy("label", F.col("e.idx").cast("long").alias("idx")).agg(F.sum("e.val").alias("total"))


@query("a11_submission", "SELECT o_orderkey, round(o_totalprice * 0.5, 4) AS prediction FROM orders")
def submission(spark, d):
    out = load(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") * 0.5).alias("prediction"))
    path = S.write_submission(out, scratch_path(spark, "submission"), sample=out.limit(0))
    return R.read_csv(spark, path, out.schema).select("o_orderkey", r("prediction", 4).alias("prediction"))


@query("a13_feature_index", INDEX_SQL + "SELECT feature, CAST(idx AS BIGINT) AS idx FROM ix")
def feature_index(spark, d):
    _, index = _index(spark, d)
    return S.load_index(spark, S.save_index(index, scratch_path(spark, "index")))


@query("a13_field_offsets", INDEX_SQL + 'SELECT field, count(*) AS size, CAST(min(idx) AS BIGINT) AS "offset" FROM ix GROUP BY field')
def offsets(spark, d):
    _, index = _index(spark, d)
    return field_offsets(index)


@query("a14_page_links", r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\b[^>]*\bhref="([^"]*)"', 1) AS ls FROM pages)
SELECT page_id, CAST(unnest(range(0, len(ls))) AS INTEGER) AS pos, unnest(ls) AS href FROM l""")
def page_links(spark, d):
    return P.extract_links(load(spark, d, "pages"), "page_id", "html")


@query("a14_page_text", r"""
WITH v AS (SELECT page_id, regexp_replace(html, '(?s)<(script|style)\b.*?</(script|style)>', '', 'g') AS h FROM pages),
p AS (SELECT page_id, regexp_replace(regexp_extract(h, '(?s)<p\b[^>]*>(.*?)</p>', 1), '(?s)<[^>]*>', '', 'g') AS t FROM v)
SELECT page_id, replace(regexp_replace(t, '\r\n[ \t\r\n]+', chr(10), 'g'), chr(10) || chr(10), chr(10)) AS text FROM p""")
def page_text(spark, d):
    return P.extract_text(load(spark, d, "pages"), "page_id", "html")


@query("a15_predictions", "SELECT doc_id, quality AS target, round(CAST(quality * 0.7 + 0.1 AS DOUBLE), 6) AS prediction FROM labels")
def predictions(spark, d):
    scored = load(spark, d, "labels").withColumn("p", F.col("quality") * 0.7 + 0.1)
    path = S.persist_predictions(scored, scratch_path(spark, "predictions"), "doc_id", "quality", "p")
    return R.read_parquet(spark, path).withColumn("prediction", r("prediction"))
