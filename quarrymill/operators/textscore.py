"""Scores of generated text against references: rows of (id, hyp, refs array)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.arrays import cosine
from ..functions.text import counted, ngrams, strip, tokens
from ..plans.scalars import Scalars
from ..plans.session import materialise, measure, settle
from ..plans.skew import is_small, lookup_join
from .lookups import block_count, look_up

# Fixed values
TINY, SMALL = 1e-15, 1e-9
BETA = 1.2
DELIMITER = "||<|>||"
METRICS = ("bleu_1", "bleu_2", "bleu_3", "bleu_4", "rouge_l", "cider")


def split_references(df: DataFrame, refs: str) -> DataFrame:
    """Reference lists kept in one delimited string to an array."""
    return df.withColumn(refs, F.transform(F.split(F.col(refs), DELIMITER.replace("|", r"\|")), strip))


def pair_streams(hyp: DataFrame, streams: Sequence[DataFrame], key: str, text: str) -> DataFrame:
    """Hypothesis lines and reference streams, aligned by line key, to (id, hyp, refs)."""
    out = hyp.select(F.col(key).alias("id"), strip(text).alias("hyp"))
    for i, s in enumerate(streams):
        out = out.join(s.select(F.col(key).alias("id"), strip(text).alias(f"__r{i}")), "id")
    return out.select("id", "hyp", F.array(*[f"__r{i}" for i in range(len(streams))]).alias("refs"))


def read_scored_files(spark, hyp_path: str, ref_paths: Sequence[str]) -> DataFrame:
    """Hypothesis file and reference files, matched by line number."""
    from ..sources.readers import number_lines

    return pair_streams(number_lines(spark, hyp_path), [number_lines(spark, p) for p in ref_paths], "line", "value")


def write_numbered_files(df: DataFrame, folder: str, streams: int) -> tuple[str, list[str]]:
    """(id, hyp, refs) rows as text: a folder of hypotheses and one per reference stream, lines ``id<TAB>text`` in as many files as
    there are partitions. A row without a reference in a stream has no line there."""
    df = materialise(df)
    paths = []
    for name, text in [("hyp", F.col("hyp")), *[(f"ref{i}", F.get("refs", F.lit(i))) for i in range(streams)]]:
        lines = df.select(F.concat_ws("\t", F.col("id").cast("string"), text).alias("value"), text.alias("t")).filter("t IS NOT NULL")
        lines.select("value").write.text(f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    return paths[0], paths[1:]


def read_numbered_files(spark, hyp_path: str, ref_paths: Sequence[str]) -> DataFrame:
    """(id, hyp, refs) from files of ``id<TAB>text`` lines in any order; references in the order of the streams that have one."""

    def lines(path):
        parts = F.split("value", "\t", 2)
        return spark.read.text(path).select(parts[0].cast("long").alias("id"), strip(parts[1]).alias("text"))

    out = lines(hyp_path).withColumnRenamed("text", "hyp")
    for i, path in enumerate(ref_paths):
        out = out.join(lines(path).withColumnRenamed("text", f"__r{i}"), "id", "left")
    return out.select("id", "hyp", F.array_compact(F.array(*[f"__r{i}" for i in range(len(ref_paths))])).alias("refs"))


def once_and_again(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key no other row has, and the others (None if there are none). Keys are compared by a hash, so a unique key may
    be among the others, but never the other way round; null is a key like any other."""
    marked = df.withColumn("__h", F.xxhash64(*key))
    again = marked.groupBy("__h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialise(again.withColumn("__again", F.lit(True)))
    if measure(again)[0] == 0:
        return df, None
    table = again.select("__h", "__again")
    table._measured = again._measured
    found = lookup_join(marked, table, ["__h"], counts=again.select("__h", "n"), ready=True)
    return found.filter("__again IS NULL").select(*df.columns), found.filter("__again").select(*df.columns)


def gram_counts(df: DataFrame, key: Sequence[str], words: Column, n: int = 4) -> DataFrame:
    """Counts of all n-grams up to ``n`` per key. A row that has its key alone is counted inside the row, so its n-grams are not
    shuffled."""
    once, again = once_and_again(df.select(*key, words.alias("__w")), key)

    def of_order(k: int) -> Column:
        return F.transform(counted(ngrams(F.col("__w"), k)), lambda g: F.struct(F.lit(k).alias("n"), g["item"].alias("gram"), g["c"].alias("c")))

    def inside(rows: DataFrame) -> DataFrame:
        grams = F.concat(*[of_order(k) for k in range(1, n + 1)])
        return rows.select(*key, F.explode(grams).alias("g")).select(*key, "g.n", "g.gram", "g.c")

    if again is None:
        return inside(once)
    return inside(once).unionByName(inside(again).groupBy(*key, "n", "gram").agg(F.sum("c").alias("c")))


def _refs_long(df: DataFrame) -> DataFrame:
    return df.select("id", F.posexplode("refs").alias("r", "ref"))


def clipped_matches(df: DataFrame, n: int = 4) -> DataFrame:
    """Per row and order: n-grams of the hypothesis matched in the references, each at most as often as in one of them.

    A row that has its id alone is matched inside the row. Of the others both sides enter one aggregate per (row, n-gram), so
    no join is needed."""
    once, again = once_and_again(settle(df).select("id", "hyp", "refs"), ["id"])
    words = [tokens("hyp"), F.transform("refs", lambda r: tokens(r))]
    rows = once.select("id", F.posexplode(_row_matches(n)(*words)).alias("n", "correct"))
    inside = rows.filter("correct IS NOT NULL").select("id", (F.col("n") + 1).alias("n"), "correct")
    return inside if again is None else inside.unionByName(_matches_by_id(again, n))


def _row_matches(n: int):
    """Matches of each order within a row; null for an order of which neither side has an n-gram."""

    def one(hyp, refs):
        out = []
        refs = [r for r in (refs if refs is not None else []) if r is not None]
        for k in range(1, n + 1):
            count = lambda w: Counter(zip(*[w[i:] for i in range(k)]))
            h = count(hyp) if hyp is not None else Counter()
            best = [count(r) for r in refs]
            if h or any(best):
                out.append(sum(min(c, max((b[g] for b in best if g in b), default=0)) for g, c in h.items()))
            else:
                out.append(None)
        return out

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def matches(hyp: pd.Series, refs: pd.Series) -> pd.Series:
        return pd.Series([one(h, r) for h, r in zip(hyp, refs)], dtype="object")

    return matches


def _matches_by_id(df: DataFrame, n: int) -> DataFrame:
    hyp = gram_counts(df, ["id"], tokens("hyp"), n).select("id", "n", "gram", F.col("c").alias("h"), F.lit(0).cast("long").alias("m"))
    refs = gram_counts(_refs_long(df), ["id", "r"], tokens("ref"), n).select("id", "n", "gram", F.lit(0).cast("long").alias("h"), F.col("c").alias("m"))
    both = hyp.unionByName(refs).groupBy("id", "n", "gram").agg(F.max("h").alias("h"), F.max("m").alias("m"))
    return both.groupBy("id", "n").agg(F.sum(F.least("h", "m")).alias("correct"))


def bleu_parts(df: DataFrame, n: int = 4) -> DataFrame:
    """Per row: hypothesis length, closest reference length (the shorter one on ties), guesses and matches per order."""
    df = settle(df)
    length = F.size(tokens("hyp"))
    sizes = F.transform("refs", lambda r: F.size(tokens(r)))
    closest = F.array_min(F.transform(sizes, lambda s: F.struct(F.abs(s - length).alias("d"), s.alias("l"))))["l"]
    lengths = df.select("id", length.cast("long").alias("testlen"), closest.cast("long").alias("reflen"))
    wide = clipped_matches(df, n).groupBy("id").agg(*[F.coalesce(F.sum(F.when(F.col("n") == k, F.col("correct"))), F.lit(0)).alias(f"correct{k}") for k in range(1, n + 1)])
    out = lengths.join(wide, "id", "left").na.fill(0)
    return out.select("*", *[F.greatest(F.col("testlen") - (k - 1), F.lit(0)).alias(f"guess{k}") for k in range(1, n + 1)])


def _bleu_columns(n: int) -> list[Column]:
    ratio = (F.col("testlen") + TINY) / (F.col("reflen") + SMALL)
    brevity = F.when(ratio < 1, F.exp(1 - 1 / ratio)).otherwise(F.lit(1.0))
    product, out = F.lit(1.0), []
    for k in range(1, n + 1):
        product = product * (F.col(f"correct{k}") + TINY) / (F.col(f"guess{k}") + SMALL)
        out.append((F.pow(product, F.lit(1.0 / k)) * brevity).alias(f"bleu_{k}"))
    return out


def bleu(df: DataFrame, n: int = 4) -> DataFrame:
    return bleu_parts(df, n).select("id", *_bleu_columns(n))


def bleu_corpus(df: DataFrame, n: int = 4) -> DataFrame:
    parts = bleu_parts(df, n)
    sums = parts.agg(*[F.sum(c).alias(c) for c in parts.columns if c != "id"])
    return sums.select(*_bleu_columns(n))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def lcs_lengths(hyp: pd.Series, refs: pd.Series) -> pd.Series:
    """Longest common subsequence with each reference, by bit rows (one wide integer per pair), whole texts."""

    def one(a, b) -> int:
        places: dict = {}
        for i, t in enumerate(a):
            places[t] = places.get(t, 0) | (1 << i)
        full = (1 << len(a)) - 1
        row = full
        for t in b:
            hit = row & places.get(t, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(a) - row.bit_count()

    return pd.Series([[one(h, r) for r in rs] for h, rs in zip(hyp, refs)])


def rouge_l(df: DataFrame) -> DataFrame:
    """Longest-common-subsequence F-measure; best precision and best recall are taken over references separately."""
    base = df.select("id", F.split("hyp", " ").alias("h"), F.transform("refs", lambda r: F.split(r, " ")).alias("r"))
    cut = base.select("id", "h", "r", lcs_lengths("h", "r").alias("l"))
    precision = F.array_max(F.transform("l", lambda x: x / F.size("h")))
    recall = F.array_max(F.zip_with("l", "r", lambda x, r: x / F.size(r)))
    score = F.when(
        (precision > 0) & (recall > 0), (1 + BETA**2) * precision * recall / (recall + BETA**2 * precision)
    ).otherwise(F.lit(0.0))
    return cut.select("id", score.alias("rouge_l"))


def _packed_grams(df: DataFrame, n: int) -> DataFrame:
    """(id, __side, __order, __terms, __count): the distinct n-grams of a row's hypothesis (side 0) and references (1, 2, ...) by
    their 64-bit hashes, as arrays of equal length."""
    words = F.transform(F.concat(F.array("hyp"), F.coalesce("refs", F.array().cast("array<string>"))), lambda t: tokens(t))

    def of_order(w: Column, k: int) -> Column:
        return F.transform(counted(F.transform(ngrams(w, k), lambda g: F.xxhash64(g))), lambda x: F.struct(F.lit(k).cast("byte").alias("k"), x["item"].alias("g"), x["c"].cast("int").alias("c")))

    rows = df.select("id", words.alias("__w"))
    sides = F.transform("__w", lambda w, i: F.struct(i.alias("i"), F.concat(*[of_order(w, k) for k in range(1, n + 1)]).alias("x")))
    flat = F.flatten(F.transform("__s", lambda s: F.transform(s["x"], lambda x: F.struct(s["i"].alias("i"), x["k"].alias("k"), x["g"].alias("g"), x["c"].alias("c")))))
    rows = rows.select("id", sides.alias("__s")).select("id", flat.alias("__x"))
    return rows.select("id", F.col("__x.i").alias("__side"), F.col("__x.k").alias("__order"), F.col("__x.g").alias("__terms"), F.col("__x.c").alias("__count"))


def _row_consensus(n: int, sigma: float):
    """Sum over references of a row's penalised cosines, from its packed n-grams and their inverse document frequencies."""

    def one(side, order, gram, count, idf):
        weight = count * idf
        starts = np.flatnonzero(np.r_[True, side[1:] != side[:-1], True]) if len(side) else [0]
        if not len(side) or side[0] != 0:
            return 0.0
        sums = lambda at, w: np.bincount(at, w, n + 1)
        end = starts[1]
        # the order is part of what is matched, though texts of different orders differ
        by = np.lexsort((order[:end], gram[:end]))
        held, held_order, held_weight = gram[:end][by], order[:end][by], weight[:end][by]
        norm_h, length_h = np.sqrt(sums(order[:end], weight[:end] ** 2)), count[:end][order[:end] == 2].sum()
        total = 0.0
        for a, b in zip(starts[1:-1], starts[2:]):
            g, o, w = gram[a:b], order[a:b], weight[a:b]
            place = np.minimum(np.searchsorted(held, g), end - 1)
            hit = (held[place] == g) & (held_order[place] == o)
            if not hit.any():
                continue
            dot = sums(o[hit], np.minimum(held_weight[place[hit]], w[hit]) * w[hit])
            both = norm_h * np.sqrt(sums(o, w * w))
            value = np.divide(dot, both, out=dot.copy(), where=both != 0)
            gap = float(length_h - count[a:b][o == 2].sum())
            total += value.sum() * np.exp(-(gap * gap) / (2 * sigma * sigma))
        return float(total)

    @F.pandas_udf(T.DoubleType())
    def consensus(side: pd.Series, order: pd.Series, gram: pd.Series, count: pd.Series, idf: pd.Series) -> pd.Series:
        return pd.Series([one(*x) for x in zip(side, order, gram, count, idf)], dtype="float64")

    return consensus


def cider(df: DataFrame, n: int = 4, sigma: float = 6.0) -> DataFrame:
    """Consensus score: clipped cosine of tf-idf n-gram vectors with a length penalty, mean over orders and references,
    times 10. Document frequency counts the rows whose references hold the n-gram.

    A row that has its id alone is counted and scored inside the row and looks its n-grams up by blocks; only rows with repeated
    ids are shuffled by n-gram. N-grams are told apart by 64-bit hashes. Those of one row's references alone weigh as much as
    unknown ones, so they are not in the table."""
    df = settle(df)
    once, again = once_and_again(df.select("id", "hyp", "refs"), ["id"])
    # a few files may hold all rows: the counting is dealt out by row
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(_packed_grams(once.repartition(spread), n))
    referred = F.array_distinct(F.filter(F.col("__terms"), lambda g, i: F.get("__side", i) > 0))
    seen = rows.select(F.explode(referred).alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("df"))
    if again is not None:
        more = materialise(_grams_by_id(again, n))
        distinct = more.filter("side > 0").select("id", "entry").distinct().groupBy("entry").agg(F.count(F.lit(1)).alias("df"))
        seen = seen.unionByName(distinct).groupBy("entry").agg(F.sum("df").alias("df"))
    log_rows = F.ln(Scalars(df, n=F.count(F.lit(1)))["n"].cast("double"))
    table = materialise(seen.filter("df > 1").select("entry", (log_rows - F.ln(F.col("df").cast("double"))).alias("idf")))
    found = look_up(rows, "__terms", table, "idf", "__idf", F.xxhash64("id", "__terms"))
    idf = F.transform("__idf", lambda x: F.coalesce(x, F.col("__unknown")))
    scored = found.withColumn("__unknown", log_rows).select("id", _row_consensus(n, sigma)("__side", "__order", "__terms", "__count", idf).alias("v"))
    if again is not None:
        scored = scored.unionByName(_consensus_by_id(more, table, log_rows, sigma))
    out = df.select("id", F.size("refs").alias("__k")).join(scored.filter("id IS NOT NULL"), "id", "left")
    return out.select("id", (F.coalesce("v", F.lit(0.0)) / n / F.col("__k") * 10).alias("cider"))


def _grams_by_id(df: DataFrame, n: int) -> DataFrame:
    """Counts per (id, side, order, n-gram) of rows that share their ids."""
    packed = _packed_grams(df, n)
    item = F.explode(F.arrays_zip("__side", "__order", "__terms", "__count")).alias("x")
    long = packed.select("id", item).select("id", F.col("x.__side").alias("side"), F.col("x.__order").alias("n"), F.col("x.__terms").alias("entry"), F.col("x.__count").alias("c"))
    return long.groupBy("id", "side", "n", "entry").agg(F.sum("c").alias("c"))


def _consensus_by_id(grams: DataFrame, table: DataFrame, log_rows: Column, sigma: float) -> DataFrame:
    """(id, v): what ``_row_consensus`` gives, for n-grams counted over the rows of an id."""
    weight = F.col("c") * F.coalesce("idf", log_rows)
    known = materialise(lookup_join(grams, table, ["entry"], salt_on=["id", "side"], ready=True).select("id", "side", "n", "entry", "c", weight.alias("w")))
    h, r = known.filter("side = 0").drop("side"), known.filter("side > 0").withColumnRenamed("side", "r")

    def sides(v: DataFrame, key: list[str], tag: str) -> DataFrame:
        return v.groupBy(*key, "n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias(f"norm_{tag}"))

    def lengths(v: DataFrame, key: list[str], tag: str) -> DataFrame:
        # the length counts bigrams, which is part of how the score is defined
        return v.groupBy(*key).agg(F.coalesce(F.sum(F.when(F.col("n") == 2, F.col("c"))), F.lit(0)).alias(f"len_{tag}"))

    dots = (
        h.withColumnRenamed("w", "wh").drop("c")
        .join(r.withColumnRenamed("w", "wr").drop("c"), ["id", "n", "entry"])
        .groupBy("id", "r", "n")
        .agg(F.sum(F.least("wh", "wr") * F.col("wr")).alias("dot"))
    )
    cos = dots.join(sides(h, ["id"], "h"), ["id", "n"]).join(sides(r, ["id", "r"], "r"), ["id", "r", "n"])
    value = F.when((F.col("norm_h") != 0) & (F.col("norm_r") != 0), F.col("dot") / (F.col("norm_h") * F.col("norm_r"))).otherwise(F.col("dot"))
    per_ref = cos.groupBy("id", "r").agg(F.sum(value).alias("v"))
    per_ref = per_ref.join(lengths(h, ["id"], "h"), "id").join(lengths(r, ["id", "r"], "r"), ["id", "r"])
    delta = (F.col("len_h") - F.col("len_r")).cast("double")
    penalised = per_ref.select("id", (F.col("v") * F.exp(-(delta * delta) / F.lit(2 * sigma * sigma))).alias("v"))
    return penalised.groupBy("id").agg(F.sum("v").alias("v"))


def omitted(omit: Sequence[str], names: Sequence[str] = METRICS) -> list[str]:
    """Metric names left after the omission; leaving out BLEU of one order leaves out the higher ones."""
    cut = min([int(m.split("_")[1]) for m in omit if m.startswith("bleu_")], default=99)
    return [m for m in names if m not in omit and not (m.startswith("bleu_") and int(m.split("_")[1]) >= cut)]


def evaluate(df: DataFrame, omit: Sequence[str] = ()) -> DataFrame:
    """One row of corpus scores."""
    names = omitted(omit)
    df = settle(df)
    parts = []
    if any(m.startswith("bleu") for m in names):
        order = max(int(m.split("_")[1]) for m in names if m.startswith("bleu"))
        parts.append(bleu_corpus(df, order))
    if "rouge_l" in names:
        parts.append(rouge_l(df).agg(F.avg("rouge_l").alias("rouge_l")))
    if "cider" in names:
        parts.append(cider(df).agg(F.avg("cider").alias("cider")))
    parts = [materialise(p) for p in parts]  # one row each, worked out once for all its columns
    cols = [Scalars(p, **{c: F.first(c) for c in p.columns})[c].alias(c) for p in parts for c in p.columns if c in names]
    return df.sparkSession.range(1).select(*cols)


def _sentences(df: DataFrame) -> DataFrame:
    """(id, __sides, __counts, __tokens): the distinct tokens of a row's hypothesis (side 0) and references (1, 2, ...), as arrays of
    equal length. Rows of one id are brought together; a token may then stand more than once on a side."""
    sides = F.transform(F.concat(F.array("hyp"), "refs"), lambda t, i: F.transform(counted(tokens(t)), lambda x: F.struct(i.alias("i"), x["c"].alias("c"), x["item"].alias("t"))))
    rows = df.select("id", F.flatten(F.array_compact(sides)).alias("__x")).filter("id IS NOT NULL AND size(__x) > 0")
    once, again = once_and_again(rows, ["id"])
    if again is not None:
        once = once.unionByName(again.groupBy("id").agg(F.flatten(F.collect_list("__x")).alias("__x")))
    return once.select("id", F.col("__x.i").alias("__sides"), F.col("__x.c").alias("__counts"), F.col("__x.t").alias("__tokens"))


def token_vectors(df: DataFrame, vectors: DataFrame) -> DataFrame:
    """Sentences and the vectors of their tokens, for the scores that follow; unknown tokens take the mean vector. Rows are dealt to
    blocks, and a partition has the mean of all, the vectors of a block's distinct tokens and its rows, in this order. So a vector
    travels once a block, not once a token."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    table = materialise(vectors.select("token", F.col("vector").cast("array<double>").alias("vector")))
    rows = materialise(_sentences(settle(df)))
    n = block_count(rows, "__tokens")
    block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("__block")
    mean = Scalars(table, v=vector_to_array(Summarizer.mean(array_to_vector("vector"))))["v"]
    means = df.sparkSession.range(n).select(F.col("id").cast("int").alias("__block"), F.lit(0).alias("__kind"), mean.alias("vector"))
    wanted = rows.select(block, F.explode(F.array_distinct("__tokens")).alias("token")).distinct()
    known = wanted.join(F.broadcast(table) if is_small(table) else table, "token")
    # vectors that lose nothing by it travel as floats
    exact = table.filter(F.exists("vector", lambda x: x != x.cast("float").cast("double"))).isEmpty()
    kind = "array<float>" if exact else "array<double>"
    parts = [
        means.withColumn("vector", F.col("vector").cast("array<double>")),
        known.select("__block", F.lit(1).alias("__kind"), "token", F.col("vector").cast(kind).alias("known")),
        rows.select(block, F.lit(2).alias("__kind"), "id", "__sides", "__counts", "__tokens"),
    ]
    every = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    return every.repartition(n, "__block").sortWithinPartitions("__block", "__kind")


def _best_over_refs(found: DataFrame, name: str, prepare, compare) -> DataFrame:
    """The best score of a row's hypothesis with its references. ``prepare`` turns the vectors and counts of a side into what
    ``compare`` takes two of."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def matrix(column) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def score(places, sides, counts, vectors, mean):
        each = {}
        for side in np.unique(sides):
            at = sides == side
            held = vectors[places[at]].astype("f8")
            held[places[at] < 0] = mean
            each[side] = prepare(held, counts[at].astype("f8"))
        hyp = each.pop(0, None)
        return None if hyp is None or not each else max(compare(hyp, ref) for ref in each.values())

    def run(batches):
        block = None
        for batch in batches:
            kinds, blocks = (batch.column(c).to_numpy() for c in ("__kind", "__block"))
            cuts = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1]), True])
            for start, stop in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(start, stop - start)
                if block != blocks[start]:
                    block, held, words, vectors, mean = blocks[start], [], [], None, np.zeros(1)
                if kinds[start] == 0:
                    mean = matrix(part.column("vector"))[0] if part.column("vector").null_count == 0 else mean
                elif kinds[start] == 1:
                    held.append(matrix(part.column("known")))
                    words.append(part.column("token"))
                else:
                    if vectors is None:
                        vectors, held = np.concatenate(held or [mean[None]]), []
                        words = pa.chunked_array(words, pa.string()).combine_chunks()
                    lists = part.column("__tokens")
                    places = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False)
                    sides, counts = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("__sides", "__counts"))
                    ends = np.r_[0, lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()]
                    values = [score(places[a:b], sides[a:b], counts[a:b], vectors, mean) for a, b in zip(ends[:-1], ends[1:])]
                    yield pa.record_batch({"id": part.column("id"), name: pa.array(values, pa.float64())})

    kind = found.schema["id"].dataType
    out = found.mapInArrow(run, T.StructType([T.StructField("id", kind), T.StructField(name, T.DoubleType())]))
    return out.filter(F.col(name).isNotNull())


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    both = np.sqrt(a @ a) * np.sqrt(b @ b)
    return float(a @ b / both) if both != 0 else 0.0


def emb_average(found: DataFrame) -> DataFrame:
    """Cosine of summed token vectors."""
    return _best_over_refs(found, "emb_average", lambda m, k: k @ m, _cosine)


def emb_extrema(found: DataFrame) -> DataFrame:
    """Cosine of the vectors that keep, per dimension, the value of largest magnitude."""

    def ends(m, k):
        hi, lo = m.max(axis=0), m.min(axis=0)
        return np.where((lo != 0) & ((lo > 0) | (hi > -lo)), hi, lo)

    return _best_over_refs(found, "emb_extrema", ends, _cosine)


def emb_greedy(found: DataFrame) -> DataFrame:
    """Mean of the best cosine per token in both directions; repeated tokens count by their number."""

    def units(m, k):
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(size == 0, 1, size), k

    def both_ways(hyp, ref):
        (h, hn), (r, rn) = hyp, ref
        sim = h @ r.T
        return float((np.average(sim.max(axis=1), weights=hn) + np.average(sim.max(axis=0), weights=rn)) / 2)

    return _best_over_refs(found, "emb_greedy", units, both_ways)


def vector_cosine(df: DataFrame, hyp: str, refs: str) -> DataFrame:
    """Best cosine of a sentence vector with its reference vectors."""
    best = F.array_max(F.transform(refs, lambda r: F.coalesce(cosine(F.col(hyp), r), F.lit(0.0))))
    return df.select("id", best.alias("vector_cosine"))
