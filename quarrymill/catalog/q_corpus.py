"""O: text preparation on documents and conversations."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus as C
from ..plans.session import settle
from ..sources.readers import pair_lines
from .registry import load, query, r

TOK = r"list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '')"
STRIP = r"regexp_replace(text, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')"


def words():
    return T.tokens("text")


@query("o01_tokens", f"SELECT doc_id, CAST(len({TOK}) AS INTEGER) AS n, md5(array_to_string({TOK}, ' ')) AS h FROM documents")
def tokens(spark, d):
    return load(spark, d, "documents").select("doc_id", F.size(words()).alias("n"), F.md5(F.array_join(words(), " ")).alias("h"))


@query("o02_chars", "SELECT doc_id, CAST(len(string_split(lower(text), '')) AS INTEGER) AS n, md5(array_to_string(string_split(lower(text), ''), '|')) AS h FROM documents")
def chars(spark, d):
    c = T.chars("text")
    return load(spark, d, "documents").select("doc_id", F.size(c).alias("n"), F.md5(F.array_join(c, "|")).alias("h"))


@query("o03_normalize_basic", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(text), '[~,!?"'':;)(]', '', 'g'), '[0-9]+', '', 'g'), '([?!.])', ' \1', 'g') AS text FROM documents""")
def basic(spark, d):
    return load(spark, d, "documents").select("doc_id", T.normalize_basic("text").alias("text"))


@query("o04_normalize_ascii", rf"""
SELECT doc_id, regexp_replace(regexp_replace(translate(lower({STRIP}), '{T.ACCENTED}', '{T.PLAIN}'), '([.!?])', ' \1', 'g'), '[^a-zA-Z.!?]+', ' ', 'g') AS text FROM documents""")
def ascii_table(spark, d):
    return load(spark, d, "documents").select("doc_id", T.normalize_ascii("text").alias("text"))


@query("o04_normalize_ascii_full", rf"""
SELECT doc_id, regexp_replace(regexp_replace(strip_accents(lower({STRIP})), '([.!?])', ' \1', 'g'), '[^a-zA-Z.!?]+', ' ', 'g') AS text FROM documents""")
def ascii_full(spark, d):
    return load(spark, d, "documents").select("doc_id", T.normalize_ascii_full("text").alias("text"))


@query("o05_half_to_full", "SELECT doc_id, translate(text, ',.“”', '，。\"\"') AS text FROM documents")
def full_width(spark, d):
    return load(spark, d, "documents").select("doc_id", T.half_to_full("text").alias("text"))


@query("o06_bytes_to_text", "SELECT doc_id, text FROM documents")
def bytes_to_text(spark, d):
    bad = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    raw = F.concat(F.encode("text", "UTF-8"), bad)
    return load(spark, d, "documents").select("doc_id", T.to_text(raw).alias("text"))


# Phrases and their markers
MARKERS = {"tion": "[unused1]", "and": "[unused2]"}


@query("o07_substitute", """
WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)tion', '[unused1]', 'g'), '(?i)and', '[unused2]', 'g') AS marked FROM documents)
SELECT doc_id, marked, replace(replace(marked, '[unused1]', 'tion'), '[unused2]', 'and') AS back FROM s""")
def substitute(spark, d):
    marked = load(spark, d, "documents").select("doc_id", T.substitute("text", MARKERS).alias("marked"))
    return marked.withColumn("back", T.restore("marked", MARKERS))


COUNTS = f"WITH t AS (SELECT doc_id, {TOK} AS w FROM documents), c AS (SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM t) GROUP BY 1)"
VOCAB = COUNTS + ", v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id, n FROM c WHERE n > 1)"


@query("o08_term_counts", COUNTS + " SELECT token, n FROM c")
def term_counts(spark, d):
    return C.term_counts(load(spark, d, "documents"), words())


@query("o09_vocab", VOCAB + " SELECT token, CAST(id AS BIGINT) AS id, n FROM v")
def vocab(spark, d):
    return C.build_vocab(load(spark, d, "documents"), words())


@query("o10_vocab_specials", COUNTS + """
SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 AS id, n FROM c WHERE n > 4
UNION ALL SELECT unnest(['<pad>', '<unk>', '<s>', '</s>']), unnest([0, 1, 2, 3]), 0""")
def vocab_specials(spark, d):
    return C.build_vocab(load(spark, d, "documents"), words(), above=4, specials=C.SPECIALS)


@query("o11_encode_skip", VOCAB + """
, p AS (SELECT doc_id, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM t), e AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM p JOIN v USING (token) GROUP BY 1),
a AS (SELECT t.doc_id, coalesce(ids, []) AS ids FROM t LEFT JOIN e USING (doc_id))
SELECT doc_id, array_to_string(list_concat(ids[1:1000], list_transform(range(0, greatest(1000 - len(ids), 0)), lambda i: 0)), ',') AS ids FROM a""")
def encode_skip(spark, d):
    docs = load(spark, d, "documents")
    out = C.encode_skip(docs, "doc_id", words(), C.build_vocab(docs, words()), maxlen=1000)
    return out.select("doc_id", F.array_join("ids", ",").alias("ids"))


@query("o12_encode_unk", COUNTS + """
, v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 AS id FROM c WHERE n > 4), p AS (SELECT doc_id, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM t),
e AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS ids FROM p LEFT JOIN v USING (token) GROUP BY 1), a AS (SELECT t.doc_id, coalesce(ids, []) AS ids FROM t LEFT JOIN e USING (doc_id)),
s AS (SELECT doc_id, list_concat(ids[1:999], [3]) AS ids FROM a)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS length, array_to_string(list_concat(ids, list_transform(range(0, 1000 - len(ids)), lambda i: 0)), ',') AS ids FROM s""")
def encode_unk(spark, d):
    docs = load(spark, d, "documents")
    vocab = C.build_vocab(docs, words(), above=4, specials=C.SPECIALS)
    out = C.encode_unk(docs, "doc_id", words(), vocab, maxlen=1000)
    return out.select("doc_id", "length", F.array_join("ids", ",").alias("ids"))


@query("o13_decode", COUNTS + """
, p AS (SELECT doc_id, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM t),
e AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM p JOIN c USING (token) WHERE n > 4 AND pos < 999 GROUP BY 1)
SELECT t.doc_id, coalesce(text, '') AS text FROM t LEFT JOIN e USING (doc_id)""")
def decode(spark, d):
    docs = load(spark, d, "documents")
    vocab = C.build_vocab(docs, words(), above=4, specials=C.SPECIALS)
    encoded = C.encode_unk(docs, "doc_id", words(), vocab, maxlen=1000)
    return C.decode(encoded, "doc_id", "ids", vocab)


def _asked(spark, d):
    """Every turn with its second sentence as the answer; turns of one sentence get an answer that is absent."""
    conv = load(spark, d, "conversations")
    return conv.withColumn("answer", F.coalesce(F.get(F.split("text", r"\. "), F.lit(1)), F.lit("#absent#")))


ASKED = rf"WITH q AS (SELECT conv_id, turn, {STRIP} AS t, " + STRIP.replace("text", "coalesce(string_split(text, '. ')[2], '#absent#')") + " AS a FROM conversations)"


@query("o14_tag_answer", ASKED + """
, h AS (SELECT *, strpos(t, a) AS p FROM q WHERE strpos(t, a) > 0), s AS (SELECT *, CASE WHEN p - 1 + length(a) > 126 THEN p - 1 + length(a) ELSE length(t) END AS stop FROM h),
c AS (SELECT conv_id, turn, string_split(lower(t[1:stop]), '') AS ch, list_transform(range(1, stop + 1), lambda i: CAST(i >= p AND i < p + length(a) AS INTEGER)) AS mk FROM s),
k AS (SELECT conv_id, turn, list_concat(['<s>'], ch[greatest(len(ch) - 125, 1):], ['</s>']) AS ch, list_concat([0], mk[greatest(len(mk) - 125, 1):], [0]) AS mk FROM c)
SELECT conv_id, turn, CAST(len(ch) AS INTEGER) AS length, array_to_string(list_concat(ch, list_transform(range(0, 128 - len(ch)), lambda i: '<pad>')), '') AS chars,
 array_to_string(list_concat(mk, list_transform(range(0, 128 - len(mk)), lambda i: 0)), '') AS marks FROM k""")
def tag_answer(spark, d):
    out = C.tag_answer(_asked(spark, d), ["conv_id", "turn"], "text", "answer", 128)
    return out.select("conv_id", "turn", "length", F.array_join("chars", "").alias("chars"), F.array_join("marks", "").alias("marks"))


@query("o15_encode_question", ASKED + """
, c AS (SELECT conv_id, turn, string_split(lower(t), '') AS ch FROM q), k AS (SELECT conv_id, turn, list_concat(['<s>'], ch[greatest(len(ch) - 29, 1):], ['</s>']) AS ch FROM c)
SELECT conv_id, turn, CAST(len(ch) AS INTEGER) AS length, array_to_string(list_concat(ch, list_transform(range(0, 32 - len(ch)), lambda i: '<pad>')), '') AS chars FROM k""")
def question(spark, d):
    out = C.encode_question(_asked(spark, d), ["conv_id", "turn"], "text", 32)
    return out.select("conv_id", "turn", "length", F.array_join("chars", "").alias("chars"))


@query("o15_dropped_answers", ASKED + "SELECT count(*) FILTER (WHERE strpos(t, a) = 0) AS dropped, count(*) FILTER (WHERE strpos(t, a) > 0) AS kept FROM q")
def dropped(spark, d):
    return C.dropped_answers(_asked(spark, d), "text", "answer")


@query("o16_filter_pairs", r"""
WITH l AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\r?\n'), lambda x: trim(x) <> '') AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(0, len(ls) // 2)) AS pair FROM l), x AS (SELECT doc_id, CAST(pair AS INTEGER) AS pair, ls[pair * 2 + 1] AS a, ls[pair * 2 + 2] AS b FROM p)
SELECT doc_id, pair FROM x WHERE len(list_filter(regexp_split_to_array(a, '[ \t\n\r\f\v]+'), lambda x: x <> '')) < 12 AND len(list_filter(regexp_split_to_array(b, '[ \t\n\r\f\v]+'), lambda x: x <> '')) < 12""")
def filter_pairs(spark, d):
    pairs = pair_lines(load(spark, d, "documents"), "doc_id", "text")
    return C.filter_pairs(pairs, T.tokens("part0"), T.tokens("part1"), 12).select("doc_id", "pair")


@query("o17_length_stats", f"""
WITH u AS (SELECT 'chars' AS unit, length(text) AS n FROM documents UNION ALL SELECT 'words', len({TOK}) FROM documents)
SELECT unit, max(n) AS max, min(n) AS min, round(avg(n), 4) AS mean, round(stddev_pop(n), 4) AS std, round(quantile_cont(n, 0.75), 4) AS q75 FROM u GROUP BY 1""")
def length_stats(spark, d):
    out = C.length_stats(load(spark, d, "documents"), "text")
    return out.select("unit", "max", "min", r("mean", 4).alias("mean"), r("std", 4).alias("std"), r("q75", 4).alias("q75"))


@query("o17_length_histogram", f"SELECT CAST(len({TOK}) // 50 * 50 AS BIGINT) AS low, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(spark, d):
    return C.length_histogram(load(spark, d, "documents"), words()).select(F.col("low").cast("long").alias("low"), "n")


STOP = ["the", "and", "of", "de", "la"]


@query("o18_top_words", COUNTS + " SELECT token, n FROM c WHERE token NOT IN ('the', 'and', 'of', 'de', 'la') ORDER BY n DESC, token LIMIT 50")
def top_words(spark, d):
    return C.top_words(load(spark, d, "documents"), words(), STOP, 50)


def _tfidf_sql(idf):
    weight = "(1 + ln(tf)) * (ln((1 + nd) / (1 + df)) + 1)" if idf else "1 + ln(tf)"
    return rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda x: x NOT IN ('the', 'and')) AS w FROM documents), nd AS (SELECT count(*) AS nd FROM documents),
g AS (SELECT doc_id, unnest(w) AS term FROM w UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2), df AS (SELECT term, df FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), nd WHERE df >= 10 AND df <= 0.8 * nd),
x AS (SELECT doc_id, term, {weight} AS weight FROM tf JOIN df USING (term), nd), l AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM x GROUP BY 1),
ti AS (SELECT doc_id, term, weight / len AS weight FROM x JOIN l USING (doc_id))
"""


@query("o19_tfidf", _tfidf_sql(False) + "SELECT doc_id, term, round(weight, 8) AS weight FROM ti")
def tfidf(spark, d):
    out = C.tfidf(load(spark, d, "documents"), "doc_id", "text", stop_words=["the", "and"])
    return out.withColumn("weight", r("weight", 8))


@query("o19_tfidf_smooth_idf", _tfidf_sql(True) + "SELECT doc_id, term, round(weight, 8) AS weight FROM ti")
def tfidf_idf(spark, d):
    out = C.tfidf(load(spark, d, "documents"), "doc_id", "text", stop_words=["the", "and"], use_idf=True)
    return out.withColumn("weight", r("weight", 8))


@query("o20_entropy_weights", _tfidf_sql(False) + """
, m AS (SELECT term, quality AS y, weight FROM ti JOIN labels USING (doc_id)), k AS (SELECT DISTINCT quality AS y FROM labels), t AS (SELECT term, sum(weight) AS total FROM m GROUP BY 1),
c AS (SELECT term, y, sum(weight) AS s FROM m GROUP BY 1, 2),
h AS (SELECT t.term, (coalesce(s, 0) + 1e-8) / (total + (SELECT count(*) FROM k) * 1e-8) AS p FROM t CROSS JOIN k LEFT JOIN c ON c.term = t.term AND c.y = k.y),
e AS (SELECT term, -sum(p * ln(p)) AS entropy FROM h GROUP BY 1)
SELECT term, round(entropy, 6) AS entropy, round(max(entropy) OVER () - entropy + 0.5, 6) AS weight_factor FROM e""")
def entropy(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    weights = C.tfidf(docs, "doc_id", "text", stop_words=["the", "and"], packed=True)
    out = C.entropy_weights(weights, labels, "doc_id", "quality")
    return out.select("term", r("entropy").alias("entropy"), r("weight_factor").alias("weight_factor"))


@query("o20_apply_term_weights")
def apply_weights(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    weights = settle(C.tfidf(docs, "doc_id", "text", stop_words=["the", "and"], packed=True))
    out = C.apply_term_weights(weights, C.entropy_weights(weights, labels, "doc_id", "quality"), "doc_id", "\t")
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), r(F.sum("weight"), 4).alias("total"))


@query("o21_word_vectors")
def word_vectors(spark, d):
    """Trained vectors of every word with two occurrences; SQL cannot train, the tests plant similar words."""
    from ..operators.wordvec import word_vectors as train

    return train(load(spark, d, "documents"), words(), size=100, window=5, min_count=2, rounds=3)


@query("o22_align_vectors", COUNTS + """
, v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM c WHERE n > 1)
SELECT CAST(id AS BIGINT) AS id, token, CAST(n.n <= 100 AS INTEGER) AS filled, CASE WHEN n.n > 100 THEN 1.0 ELSE
 round((CAST('0x' || substr(md5('vector:' || token || ':0'), 1, 8) AS BIGINT) / 4294967296.0 * 2 - 1) * 0.25, 6) END AS x0 FROM v JOIN c n USING (token)""")
def align(spark, d):
    docs = load(spark, d, "documents")
    vocab = C.build_vocab(docs, words())
    known = vocab.filter("n > 100").select("token", F.array_repeat(F.lit(1.0), 4).alias("vector"))
    out = C.align_vectors(vocab.select("token", "id"), known, 4)
    return out.select("id", "token", "filled", r(F.col("vector")[0]).alias("x0"))


@query("o23_cooccurrence", COUNTS + """
, p AS (SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM (SELECT doc_id, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM t) JOIN c USING (token) WHERE n >= 2),
g AS (SELECT doc_id, token, i, unnest(range(1, 16)) AS gap FROM p),
m AS (SELECT least(g.token, b.token) AS a, greatest(g.token, b.token) AS b, sum(1.0 / gap) AS weight FROM g JOIN p b ON b.doc_id = g.doc_id AND b.i = g.i + g.gap GROUP BY 1, 2)
SELECT a, count(*) AS partners, round(sum(weight), 4) AS weight FROM m GROUP BY 1""")
def cooccurrence(spark, d):
    """All pairs of words with two occurrences within 15 places, told by their first word."""
    vocab, pairs = C.cooccurrence(load(spark, d, "documents"), "doc_id", words(), window=15, min_count=2, named=False)
    out = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"), r(F.sum("weight"), 4).alias("weight"))
    return out.join(vocab, F.col("a") == F.col("word")).select(F.col("token").alias("a"), "partners", "weight")
