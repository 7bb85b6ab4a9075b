"""Vocabulary, id sequences, TF-IDF with entropy weights, co-occurrence and aligned vectors (``wordvec`` trains them)."""

from __future__ import annotations

from collections.abc import Sequence
import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import keep_tail, pad_right
from ..functions.hashing import key_uniform
from ..functions.text import chars, counted, ngrams, strip, tokens, word_tokens
from ..plans.ordering import row_numbers
from ..plans.scalars import Scalars
from ..plans.session import discard, materialise, measure, settle
from ..plans.skew import is_small, lookup_join
from .lookups import look_up
from .textscore import once_and_again
from .windows import window_pairs

# Special tokens in id order
SPECIALS = ("<pad>", "<unk>", "<s>", "</s>")
#: Parts, by the hash of a term, in which the terms of a key that several rows have are kept.
KEY_PARTS = 64


def term_counts(df: DataFrame, words: Column) -> DataFrame:
    """Occurrences of each token over the corpus."""
    return df.select(F.explode(words).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(
    df: DataFrame, words: Column, above: int = 1, below: int = 4_000_000, specials: Sequence[str] = (), start: int = 0
) -> DataFrame:
    """Tokens with ``above < count < below``, most frequent first, ids from ``start`` after the special tokens."""
    counts = term_counts(df, words).filter((F.col("n") > above) & (F.col("n") < below))
    if specials:
        counts = counts.filter(~F.col("token").isin(*specials))
    numbered = row_numbers(counts, [F.col("n").desc(), F.col("token")], name="id")
    vocab = numbered.select("token", (F.col("id") - 1 + start + len(specials)).alias("id"), "n")
    if not specials:
        return vocab
    fixed = df.sparkSession.createDataFrame(
        [(t, start + i, 0) for i, t in enumerate(specials)], "token string, id long, n long"
    )
    return fixed.unionByName(vocab)


def _looked_up(df: DataFrame, key: str, entries: Column, vocab: DataFrame, entry: str, value: str, values: Column, limit: int | None = None, written: list | None = None) -> DataFrame:
    """(key, values): ``values`` of the arrays ``__entries`` and ``__found``, the vocabulary's value for each entry, in the order of
    their positions, at most the first ``limit`` of them. Null values fall out, the key stays. Only rows whose key is repeated are
    brought together, and a row sends no more than ``limit`` of its own. ``written`` gets the tables that the result reads."""
    rows = materialise(df.select(key, entries.alias("__entries")))
    table = materialise(vocab.select(F.col(entry).alias("entry"), F.col(value).alias("value")))
    if written is not None:
        written += [rows, table]
    once, again = once_and_again(rows, [key])

    def placed(part: DataFrame) -> DataFrame:
        found = look_up(part, "__entries", table, "value", "__found", F.xxhash64(key, "__entries"))
        pairs = F.transform(values, lambda v, i: F.when(v.isNotNull(), F.struct(i.alias("pos"), v.alias("v"))))
        pairs = F.coalesce(F.array_compact(pairs), F.array())
        return found.select(key, (pairs if limit is None else F.slice(pairs, 1, limit)).alias("__placed"))

    alone = placed(once).select(key, F.col("__placed.v").alias("__values"))
    if again is None:
        return alone
    together = F.array_sort(F.flatten(F.collect_list("__placed")))["v"]
    return alone.unionByName(placed(again).groupBy(key).agg(together.alias("__values")))


def encode_skip(df: DataFrame, key: str, words: Column, vocab: DataFrame, maxlen: int = 1000, pad: int = 0) -> DataFrame:
    """Ids of the known tokens only, cut at ``maxlen`` and padded on the right."""
    ids = _looked_up(df, key, words, vocab, "token", "id", F.col("__found").cast("array<bigint>"), maxlen)
    return ids.select(key, pad_right(F.col("__values"), maxlen, pad).alias("ids"))


def encode_unk(
    df: DataFrame, key: str, words: Column, vocab: DataFrame, maxlen: int, unk: int = 1, end: int = 3, pad: int = 0, begin: int | None = None
) -> DataFrame:
    """Ids with a marker for unknown tokens, an end marker, right padding and the true length."""
    kept = maxlen - 1 - (begin is not None)
    known = F.zip_with("__entries", "__found", lambda t, v: F.when(t.isNotNull(), F.coalesce(v, F.lit(unk)).cast("long")))
    first = F.array().cast("array<bigint>") if begin is None else F.array(F.lit(begin).cast("long"))
    ids = F.concat(first, F.slice("__values", 1, kept), F.array(F.lit(end).cast("long")))
    rows = _looked_up(df, key, words, vocab, "token", "id", known, kept)
    return rows.select(key, pad_right(ids, maxlen, pad).alias("ids"), F.size(ids).alias("length"))


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, skip: Sequence[int] = (0, 1, 2, 3), joiner: str = " ") -> DataFrame:
    """Text of an id sequence without the special ids."""
    wanted = F.col(ids).cast("array<bigint>")
    if skip:
        wanted = F.transform(wanted, lambda i: F.when(~i.isin(*skip), i))
    named = vocab.select(F.col("id").cast("long").alias("id"), "token")
    found = _looked_up(df, key, wanted, named, "id", "token", F.col("__found"))
    return found.select(key, F.array_join("__values", joiner).alias("text"))


def answer_spans(text: Column, answer: Column) -> tuple[Column, Column]:
    """Characters of a text and a 0/1 mark for those inside the first occurrence of the answer."""
    at = F.instr(text, answer)
    n, m = F.char_length(text), F.char_length(answer)
    marks = F.concat(F.array_repeat(F.lit(0), at - 1), F.array_repeat(F.lit(1), m), F.array_repeat(F.lit(0), n - m - at + 1))
    return chars(text), marks


def tag_answer(df: DataFrame, key: Sequence[str], text: str, answer: str, max_len: int, begin="<s>", end="</s>", pad="<pad>"):
    """Rows whose text holds the answer: the last ``max_len - 2`` characters kept, as they are read up to the part that
    fills the length, with begin and end marks, padding and answer marks."""
    t, a = strip(text), strip(answer)
    rows = df.select(*key, t.alias("__t"), a.alias("__a")).filter(F.instr("__t", F.col("__a")) > 0)
    at, m = F.instr("__t", F.col("__a")), F.char_length("__a")
    # the part after the answer is read only while text and answer do not fill the length
    stop = F.when(at - 1 + m > max_len - 2, at - 1 + m).otherwise(F.char_length("__t"))
    rows = rows.withColumn("__r", F.substring(F.col("__t"), F.lit(1), stop))
    letters, marks = answer_spans(F.col("__r"), F.col("__a"))
    body, flags = keep_tail(letters, max_len - 2), keep_tail(marks, max_len - 2)
    seq = F.concat(F.array(F.lit(begin)), body, F.array(F.lit(end)))
    fill = F.lit(max_len) - F.size(seq)
    return rows.select(
        *key,
        F.concat(seq, F.array_repeat(F.lit(pad), fill)).alias("chars"),
        F.concat(F.array(F.lit(0)), flags, F.array(F.lit(0)), F.array_repeat(F.lit(0), fill)).alias("marks"),
        F.size(seq).alias("length"),
    )


def encode_question(df: DataFrame, key: Sequence[str], question: str, max_len: int, begin="<s>", end="</s>", pad="<pad>") -> DataFrame:
    """Last ``max_len - 2`` characters of a question between begin and end marks, padded."""
    seq = F.concat(F.array(F.lit(begin)), keep_tail(chars(strip(question)), max_len - 2), F.array(F.lit(end)))
    return df.select(*key, F.concat(seq, F.array_repeat(F.lit(pad), F.lit(max_len) - F.size(seq))).alias("chars"), F.size(seq).alias("length"))


def dropped_answers(df: DataFrame, text: str, answer: str) -> DataFrame:
    """Rows whose answer does not occur in the text, and those that are kept."""
    hit = F.instr(strip(text), strip(answer)) > 0
    return df.agg(F.count_if(~hit).alias("dropped"), F.count_if(hit).alias("kept"))


def filter_pairs(df: DataFrame, a: Column, b: Column, max_len: int) -> DataFrame:
    return df.filter((F.size(a) < max_len) & (F.size(b) < max_len))


def length_stats(df: DataFrame, text: str) -> DataFrame:
    """Maximum, minimum, mean, population deviation and exact quartile of the length in words and characters."""
    from ..plans.ordering import quantiles_from_counts, running_sums

    units = F.array(
        F.struct(F.lit("chars").alias("unit"), F.char_length(text).cast("long").alias("length")),
        F.struct(F.lit("words").alias("unit"), F.size(tokens(text)).cast("long").alias("length")),
    )
    counts = df.select(F.explode(units).alias("u")).select("u.*").groupBy("unit", "length").agg(F.count(F.lit(1)).alias("n"))
    run = materialise(running_sums(counts, ["length"], ["n"], ["unit"]))
    x, n = F.col("length").cast("double"), F.col("n")
    total = F.sum(n)
    mean = F.sum(x * n) / total
    basic = run.groupBy("unit").agg(
        F.max("length").alias("max"),
        F.min("length").alias("min"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.sum(x * x * n) / total - mean * mean, F.lit(0.0))).alias("std"),
    )
    return basic.join(quantiles_from_counts(run, "length", {"q75": 0.75}, ["unit"]), "unit")


def length_histogram(df: DataFrame, words: Column, width: int = 50) -> DataFrame:
    return df.groupBy((F.floor(F.size(words) / width) * width).alias("low")).agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, words: Column, stop: Sequence[str], k: int) -> DataFrame:
    """Most frequent tokens that are not stop words."""
    counts = term_counts(df, words)
    if stop:
        counts = counts.filter(~F.col("token").isin(*stop))
    return counts.orderBy(F.col("n").desc(), "token").limit(k)


def tfidf(
    df: DataFrame,
    key: str,
    text: str,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 10,
    max_df: float = 0.8,
    use_idf: bool = False,
    smooth: bool = True,
    sublinear: bool = True,
    normalise: bool = True,
    stop_words: Sequence[str] = (),
    packed: bool = False,
) -> DataFrame:
    """(key, term, weight): sublinear term counts, document-frequency bounds, optional smoothed idf, unit rows. With ``packed`` the
    terms of a row stay together: (key, terms), an array of (term, weight); a key that several rows have may have several.

    Terms of a row that has its key alone are counted inside the row, and rows look their terms up by blocks."""
    words = word_tokens(text)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    low, high = ngram_range
    grams = F.flatten(F.array(*[ngrams(F.col("__w"), n) for n in range(low, high + 1)]))
    once, again = once_and_again(df.select(key, words.alias("__w")), [key])
    rows = once.select(key, counted(grams).alias("__g"), F.lit(False).alias("__again"))
    if again is not None:
        tf = again.select(key, F.explode(grams).alias("item")).groupBy(key, "item").agg(F.count(F.lit(1)).alias("c"))
        part = F.pmod(F.xxhash64("item"), F.lit(KEY_PARTS))
        parts = tf.groupBy(key, part.alias("__p")).agg(F.collect_list(F.struct("item", "c")).alias("__g"))
        rows = rows.unionByName(parts.select(key, "__g", F.lit(True).alias("__again")))
    rows = materialise(rows.select(key, "__again", F.col("__g.item").alias("__terms"), F.col("__g.c").alias("__tf")))
    n_docs = Scalars(df, n=F.count(F.lit(1)))["n"]
    frequency = rows.select(F.explode("__terms").alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("df"))
    kept = frequency.filter((F.col("df") >= min_df) & (F.col("df") <= n_docs * F.lit(max_df)))
    shift = 1 if smooth else 0
    idf = F.ln((n_docs + shift) / (F.col("df") + shift)) + 1 if use_idf else F.lit(1.0)
    # no term has a tab
    found = look_up(rows, "__terms", materialise(kept.select("entry", idf.alias("idf"))), "idf", "__idf", F.xxhash64(key, "__terms"), "\t")

    def weighted(x: Column) -> Column:
        tf = 1 + F.ln(x["__tf"]) if sublinear else x["__tf"].cast("double")
        return F.struct(x["__terms"].alias("term"), (tf * x["__idf"]).alias("weight"))

    known = F.filter(F.arrays_zip("__terms", "__tf", "__idf"), lambda x: x["__idf"].isNotNull())
    rows = found.select(key, "__again", F.transform(known, weighted).alias("terms"))
    if normalise:
        squares = F.aggregate("terms", F.lit(0.0), lambda s, x: s + x["weight"] * x["weight"])
        length = F.when(F.col(key).isNotNull(), F.sqrt(squares))
        if again is not None:
            rows = materialise(rows)
            lengths = rows.filter("__again").groupBy(key).agg(F.sqrt(F.sum(squares)).alias("__len"))
            rows = lookup_join(rows, lengths, [key], salt_on=["terms"])
            length = F.when(F.col("__again"), F.col("__len")).otherwise(length)
        # an array of one entry holds the length, so that it is worked out once and not for every term
        unit = lambda l: F.transform("terms", lambda x: F.struct(x["term"].alias("term"), (x["weight"] / l).alias("weight")))
        rows = rows.select(key, F.get(F.transform(F.array(length), unit), F.lit(0)).alias("terms"))
    rows = rows.select(key, "terms")
    return rows if packed else _unpacked(rows)


def _unpacked(weights: DataFrame) -> DataFrame:
    """A row per term of packed weights."""
    if "terms" not in weights.columns:
        return weights
    return weights.withColumn("__t", F.explode("terms")).drop("terms").select("*", "__t.term", "__t.weight").drop("__t")


def entropy_weights(weights: DataFrame, labels: DataFrame, key: str, y: str, smooth: float = 1e-8) -> DataFrame:
    """Weight per term: ``max entropy - entropy + 0.5`` of its smoothed class shares. Classes in which a term does not
    occur add the smoothing alone, so they enter as a number of classes and not as rows. Packed weights meet the labels packed."""
    labels = materialise(labels.select(key, y))
    # beside a small table the terms of the rows are not shuffled
    marked = _unpacked(weights.join(F.broadcast(labels) if is_small(labels) else labels, key))
    classes = Scalars(labels.select(y).distinct(), n=F.count(F.lit(1)).cast("double"))["n"]
    per_class = marked.groupBy("term", y).agg(F.sum("weight").alias("s"))
    # -sum p ln p with p = (s + e) / b splits into plain sums over the classes seen and a count of the others
    raised = F.col("s") + smooth
    per_term = per_class.groupBy("term").agg(
        F.sum("s").alias("total"), F.count(F.lit(1)).alias("seen"), F.sum(raised).alias("a"), F.sum(raised * F.ln(raised)).alias("c")
    )
    bottom = F.col("total") + classes * smooth
    absent = (classes - F.col("seen")) * (F.lit(smooth) / bottom) * (F.ln(bottom) - math.log(smooth))
    entropy = materialise(per_term.select("term", ((F.col("a") * F.ln(bottom) - F.col("c")) / bottom + absent).alias("entropy")))
    top = Scalars(entropy, top=F.max("entropy"))["top"]
    return entropy.select("term", "entropy", (top - F.col("entropy") + 0.5).alias("weight_factor"))


def apply_term_weights(weights: DataFrame, factors: DataFrame, key: str, joiner: str | None = None) -> DataFrame:
    """(key, term, weight) of the terms that have a factor, multiplied by it. Packed weights look their terms up by blocks; for
    ``joiner`` see ``look_up``."""
    if "terms" not in weights.columns:
        found = lookup_join(weights, factors.select("term", "weight_factor"), ["term"], "inner", [key])
        return found.select(key, "term", (F.col("weight") * F.col("weight_factor")).alias("weight"))
    rows = settle(weights).select(key, F.col("terms.term").alias("__terms"), F.col("terms.weight").alias("__weights"))
    table = materialise(factors.select(F.col("term").alias("entry"), "weight_factor"))
    found = look_up(rows, "__terms", table, "weight_factor", "__factors", F.xxhash64(key, "__terms"), joiner)
    raised = F.transform(
        F.arrays_zip("__terms", "__weights", "__factors"),
        lambda x: F.when(x["__factors"].isNotNull(), F.struct(x["__terms"].alias("term"), (x["__weights"] * x["__factors"]).alias("weight"))),
    )
    return _unpacked(found.select(key, F.array_compact(raised).alias("terms")))


def cooccurrence(df: DataFrame, key: str, words: Column, window: int = 15, min_count: int = 5, named: bool = True):
    """Unordered token pairs within a window, weighted by 1 / distance, tokens below ``min_count`` left out first: (a, b, weight), or
    without ``named`` ((token, word), pairs of the numbers ``word``), which are in the order of the tokens.

    Each position meets only its next ``window`` kept tokens inside its own row. Tokens are numbered in their own order, rows look
    the numbers up by blocks, and pairs of numbers are summed by each task before the shuffle.
    """
    counts = materialise(term_counts(df, words).filter(F.col("n") >= min_count))
    vocab = materialise(row_numbers(counts, ["token"], name="word"))
    lists = _looked_up(df, key, words, vocab, "token", "word", F.col("__found"), written=(stale := [counts]))
    lists = materialise(lists.select(F.col("__values").cast("array<int>").alias("w")))
    discard(*stale)
    pairs = window_pairs(lists, "w", [1.0 / gap for gap in range(1, window + 1)], vocab)
    vocab = vocab.select("token", "word")
    if not named:
        return vocab, pairs
    if not is_small(vocab):
        pairs = materialise(pairs)
    for side, other in (("a", "b"), ("b", "a")):
        name = vocab.select(F.col("word").alias(side), F.col("token").alias(f"__{side}"))
        name._measured = measure(vocab)
        pairs = lookup_join(pairs, name, [side], "inner", [other], ready=True).drop(side).withColumnRenamed(f"__{side}", side)
    return pairs.select("a", "b", "weight")


def align_vectors(vocab: DataFrame, vectors: DataFrame, size: int, spread: float = 0.25) -> DataFrame:
    """A vector for every vocabulary token; tokens without one get small numbers drawn from the token."""
    drawn = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: (key_uniform(F.concat_ws(":", F.col("token"), i), "vector") * 2 - 1) * spread,
    )
    joined = vocab.join(vectors.select("token", "vector"), "token", "left")
    return joined.select("id", "token", F.coalesce("vector", drawn).alias("vector"), F.col("vector").isNull().cast("int").alias("filled"))
