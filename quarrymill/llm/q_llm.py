"""Registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.session import tables
from .registry import query


@query("op6_byte_bpe")
def op6(spark, d):
    import public_tokenizers

    from .bpe import round_trip

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(tables(spark, d, "documents"), path, public_tokenizers.PATTERN)


@query("op9_license_scan")
def op9(spark, d):
    from .license_scan import scan_licenses

    out = scan_licenses(tables(spark, d, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("matches", lambda m: m["coverage"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


@query("op10_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, coalesce(l.doc_id < f.keeper, false) AS gone FROM lines l LEFT JOIN frequent f USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op10(spark, d):
    from .line_dedup import dedup_lines

    out = dedup_lines(tables(spark, d, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


@query("op4_ngram_jaccard")
def op4(spark, d):
    from .jaccard_join import near_duplicates

    return near_duplicates(tables(spark, d, "documents"))


@query("op1_best_fit_packing")
def op1(spark, d):
    from .packing import count_tokens, pack_lengths

    return pack_lengths(count_tokens(tables(spark, d, "documents").select("doc_id", "text")), "doc_id", "n_tokens")


@query("op2_quality_classifier")
def op2(spark, d):
    from .exprs import crc_mod
    from .quality_pu import score_quality

    docs, labels = tables(spark, d, "documents", "labels")
    out = score_quality(docs, labels, crc_mod(F.col("doc_id"), 3) != 1)
    held = (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out")
    return out.select("doc_id", held, "score", "predicted")


@query("op3_html_extraction")
def op3(spark, d):
    from .html_text import extract_text

    out = extract_text(tables(spark, d, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op7_lm_score")
def op7(spark, d):
    from .exprs import crc_mod
    from .lm_score import score_texts

    held = crc_mod(F.col("doc_id"), 7) == 2
    out = score_texts(tables(spark, d, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_ann_search")
def op5(spark, d):
    from .ann_search import nearest

    return nearest(tables(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_embedding_dedup")
def op8(spark, d):
    from .cap_filters import near_vectors

    return near_vectors(tables(spark, d, "embeddings"))


@query("pipeline")
def pipeline(spark, d):
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


@query("op12_merkle_manifest")
def op12(spark, d):
    from .merkle_manifest import leaf_digest, manifest

    docs = tables(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    changed = leaf_digest(*[F.col(c) for c in fields[:-1]], bare)
    out = manifest(docs, "doc_id", "source", fields, F.when(even, changed))
    siblings = F.concat_ws("", F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)))
    return out.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query("op11_prefix_trie")
def op11(spark, d):
    from .exprs import crc_mod
    from .prefix_trie import prefix_trie

    c = F.col("c")
    return prefix_trie(tables(spark, d, "conversations"), c - c % 5, crc_mod(c, 9), 8)


@query("op13_language_id")
def op13(spark, d):
    from .byte_gru import identify_languages
    from .exprs import crc_mod

    held = crc_mod(F.col("doc_id"), 4) == 2
    out = identify_languages(tables(spark, d, "documents").select("doc_id", "text", "lang"), ~held)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
