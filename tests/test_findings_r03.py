"""Cases of the third round's findings: text without Python batches, pairs within windows, squares of cells."""

import random
import re
import unicodedata

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.functions import text as T
from quarrymill.operators import corpus as C, lookups, windows, wordvec as V


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_invalid_bytes_are_dropped_without_python(spark):
    rng = random.Random(3)
    pool = [b"\xef\xbf\xbd", b"\xff", b"\xef", b"\xbf", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"\xed\xa0\x80", b"\xc3", b"a", b"b", b"\x01", b"\xe0\x80"]
    rows = [bytearray(b"".join(rng.choices(pool, k=rng.randint(0, 8)))) for _ in range(2000)] + [None]
    got = spark.createDataFrame([(b,) for b in rows], "b binary").select("b", T.to_text("b").alias("t"))
    assert "ArrowEvalPython" not in _plan(got)
    for x in got.collect():
        assert x.t == (None if x.b is None else bytes(x.b).decode("utf-8", "ignore"))


def test_only_texts_that_need_it_are_decomposed_in_python(spark, monkeypatch):
    texts = ["déjà vu Ångström", "éä", "й ё ώ", "한국", "が", "ạ゙́", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = {t: None if t is None else re.sub(T.MARKS, "", unicodedata.normalize("NFD", t)) for t in texts}
    assert {x.t: x.s for x in df.select("t", T.strip_marks("t").alias("s")).collect()} == want
    monkeypatch.setattr(T, "_decomposed", lambda c: F.lit("sent"))
    sent = {x.t for x in df.select("t", T.strip_marks("t").alias("s")).collect() if x.s == "sent"}
    assert sent == {"한국", "が", "ạ゙́"}


@pytest.mark.parametrize("chunk, held", [(100_000, 2_000_000), (7, 5)])
@pytest.mark.parametrize("way", ["small", "large"])
def test_cooccurrence_sums_pairs_before_the_shuffle(spark, request, monkeypatch, way, chunk, held):
    if way == "large":
        request.getfixturevalue("big")
    monkeypatch.setattr(windows, "CHUNK_PLACES", chunk)
    monkeypatch.setattr(windows, "HELD_PAIRS", held)
    rng = random.Random(4)
    rows = [(i % 9 or None, " ".join(rng.choices("abcde", k=rng.randint(0, 12)))) for i in range(8)] + [(20, None), (21, "once")]
    count, want = {}, {}
    for _, t in rows:
        for w in (t or "").split():
            count[w] = count.get(w, 0) + 1
    for _, t in rows:
        kept = [w for w in (t or "").split() if count[w] >= 2]
        for i, x in enumerate(kept):
            for gap, y in enumerate(kept[i + 1 : i + 4], 1):
                at = tuple(sorted((x, y)))
                want[at] = want.get(at, 0) + 1 / gap
    df = spark.createDataFrame(rows, "id long, t string")
    got = C.cooccurrence(df, "id", T.tokens("t"), window=3, min_count=2)
    assert {(x.a, x.b): x.weight for x in got.collect()} == pytest.approx(want)


def test_a_task_hands_on_each_pair_once(spark):
    lists = spark.createDataFrame([([1, 2] * 500,)] * 20, "w array<long>").coalesce(1)
    out = windows.window_pairs(lists, "w", [1.0, 0.5])
    assert {(x.a, x.b): x.weight for x in out.collect()} == {(1, 2): 20 * 999.0, (1, 1): 20 * 499 * 0.5, (2, 2): 20 * 499 * 0.5}


def test_vectors_do_not_depend_on_the_squares_and_travel_once_a_square(spark, monkeypatch):
    # half a million words, fifty million pairs: each vector goes to a few squares, not to all 122 blocks
    side, _ = V._square(50_000_000, 122, 1)
    assert -(-122 // side) <= 8
    rng = random.Random(6)
    df = spark.createDataFrame([(" ".join(rng.choices([f"w{i}" for i in range(40)], k=9)),) for _ in range(200)], "t string")
    monkeypatch.setattr(V, "BLOCK_WORDS", 5)
    monkeypatch.setattr(V, "CELL_PAIRS", 30)

    def trained(blocks, pairs, least):
        monkeypatch.setattr(V, "SQUARE_BLOCKS", blocks)
        monkeypatch.setattr(V, "SQUARE_PAIRS", pairs)
        monkeypatch.setattr(V, "LEAST_SQUARES", least)
        return {x.token: np.array(x.vector) for x in V.word_vectors(df, T.tokens("t"), size=8, window=3, rounds=2).collect()}

    one, many = trained(16, 10**6, 1), trained(1, 1, 1)
    assert len(one) == 40
    for token in one:
        assert one[token] == pytest.approx(many[token], abs=1e-4)


TEXTS = [(1, "a b a zz"), (2, "c"), (2, "b a"), (None, "a b"), (None, "c"), (3, None), (4, ""), (5, "a c c b a b"), (6, "a b a zz")]


def _by_key(rows):
    out = {}
    for key, text in rows:
        out.setdefault(key, []).extend((i, w) for i, w in enumerate((text or "").split()))
    return out


@pytest.mark.parametrize("block", [32 << 20, 4])
def test_ids_are_looked_up_by_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(lookups, "BLOCK_BYTES", block)
    ids = {"a": 4, "b": 5, "c": 6}
    vocab = spark.createDataFrame([(t, i, 9) for t, i in ids.items()], "token string, id long, n long")
    df = spark.createDataFrame(TEXTS, "k long, t string")
    words = T.tokens("t")
    skip = C.encode_skip(df, "k", words, vocab, maxlen=4)
    want = {k: sorted((i, ids[w]) for i, w in v if w in ids) for k, v in _by_key(TEXTS).items()}
    got = {x.k: x.ids for x in skip.collect()}
    assert got == {k: ([i for _, i in v] + [0] * 4)[:4] for k, v in want.items()}
    unk = C.encode_unk(df, "k", words, vocab, maxlen=5)
    want = {k: [i for _, i in sorted((i, ids.get(w, 1)) for i, w in v)][:4] + [3] for k, v in _by_key(TEXTS).items()}
    got = {x.k: (x.ids, x.length) for x in unk.collect()}
    assert got == {k: ((v + [0] * 5)[:5], len(v)) for k, v in want.items()}
    name = {i: w for w, i in ids.items()}
    back = {x.k: x.text for x in C.decode(unk, "k", "ids", vocab).collect()}
    assert back == {k: " ".join(name[i] for i in v if i > 3) for k, v in want.items()}


def test_ids_of_single_keys_are_not_gathered_by_key(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(20)], "k long, t string")
    vocab = C.build_vocab(df, T.tokens("t"))
    assert "collect_list" not in _plan(C.encode_skip(df, "k", T.tokens("t"), vocab, maxlen=4))


@pytest.mark.parametrize("block", [32 << 20, 40])
def test_tfidf_by_blocks_with_repeated_keys(spark, monkeypatch, block):
    monkeypatch.setattr(lookups, "BLOCK_BYTES", block)
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices(["ab", "cd", "ef", "gh", "ij"], k=rng.randint(0, 9)))) for k in [*range(12), 3, 3, 7]]
    df = spark.createDataFrame(rows, "k long, t string")
    tf = {}
    for k, t in rows:
        w = t.split()
        for g in w + [" ".join(p) for p in zip(w, w[1:])]:
            tf.setdefault(k, {}).setdefault(g, 0)
            tf[k][g] += 1
    seen = {}
    for c in tf.values():
        for g in c:
            seen[g] = seen.get(g, 0) + 1
    n = len(rows)
    weight = {}
    for k, c in tf.items():
        w = {g: (1 + np.log(x)) * (np.log((n + 1) / (seen[g] + 1)) + 1) for g, x in c.items() if 2 <= seen[g] <= 0.6 * n}
        weight |= {(k, g): x / np.sqrt(sum(y * y for y in w.values())) for g, x in w.items()}
    args = dict(min_df=2, max_df=0.6, use_idf=True)
    got = {(x.k, x.term): x.weight for x in C.tfidf(df, "k", "t", **args).collect()}
    assert got.keys() == weight.keys() and all(abs(got[x] - weight[x]) < 1e-9 for x in got)
    # packed weights give what rows of weights give
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)], "k long, y int")
    long, packed = C.tfidf(df, "k", "t", **args), C.tfidf(df, "k", "t", packed=True, **args)
    factors = [C.entropy_weights(w, labels, "k", "y") for w in (long, packed)]
    a, b = [{x.term: x.weight_factor for x in f.collect()} for f in factors]
    assert a.keys() == b.keys() and all(abs(a[x] - b[x]) < 1e-9 for x in a)
    a, b = [{(x.k, x.term): x.weight for x in C.apply_term_weights(w, factors[0], "k").collect()} for w in (long, packed)]
    assert len(a) > 0 and a.keys() == b.keys() and all(abs(a[x] - b[x]) < 1e-9 for x in a)
