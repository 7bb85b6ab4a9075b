"""Published score values, and brute force where SQL has no say."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.operators import textscore as X


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, hyp string, refs array<string>")


GOOD = [(1, "this is a good test", ["this is a test", "this is also a test"])]
CORPUS = [
    (
        1,
        "this is the model generated sentence1 which seems good enough",
        ["this is one reference sentence for sentence1", "this is one more reference sentence for sentence1"],
    ),
    (
        2,
        "this is sentence2 which has been generated by your model",
        [
            "this is a reference sentence for sentence2 which was generated by your model",
            "this is the second reference sentence for sentence2",
        ],
    ),
]


@pytest.mark.parametrize("way", ["small", "large"])
@pytest.mark.parametrize(
    "rows, want",
    [
        (GOOD, [0.799999, 0.632455, 0.5108729, 0.0000903602, 0.9070631, 0.0]),
        (CORPUS, [0.55, 0.428174, 0.284043, 0.201143, 0.522104, 1.242192]),
        ([(1, "Le test est en français.", ["Test en français.", "Le test en français."])], [0.799999, 0.632455, 0.0000051, 0.0, 0.9070631, 0.0]),
        ([(1, "テスト", ["テスト"])], [0.99999999, None, None, None, 1.0, 0.0]),
    ],
)
def test_corpus_scores(spark, rows, want, way, request):
    if way == "large":
        request.getfixturevalue("big")
    got = X.evaluate(frame(spark, rows)).first()
    for name, value in zip(X.METRICS, want):
        if value is not None:
            assert got[name] == pytest.approx(value, abs=1.5e-5), name


def test_rows_average_to_corpus(spark):
    df = frame(spark, CORPUS)
    assert X.rouge_l(df).agg(F.avg("rouge_l")).first()[0] == pytest.approx(0.522104, abs=1e-5)
    assert X.cider(df).count() == 2


def test_omission():
    assert X.omitted(["bleu_3"]) == ["bleu_1", "bleu_2", "rouge_l", "cider"]
    assert X.omitted(["cider", "rouge_l"]) == ["bleu_1", "bleu_2", "bleu_3", "bleu_4"]


def test_delimited_references(spark):
    df = spark.createDataFrame([("a b||<|>||c",)], "refs string")
    assert X.split_references(df, "refs").first()["refs"] == ["a b", "c"]


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_rouge_against_table(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 90))), [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 90))) for _ in range(2)]) for i in range(30)]
    got = {r["id"]: r["rouge_l"] for r in X.rouge_l(frame(spark, rows)).collect()}
    for i, h, refs in rows:
        cuts = [(lcs(h.split(" "), r.split(" ")), len(r.split(" "))) for r in refs]
        p, rec = max(c / len(h.split(" ")) for c, _ in cuts), max(c / n for c, n in cuts)
        want = (1 + 1.44) * p * rec / (rec + 1.44 * p) if p and rec else 0.0
        assert got[i] == pytest.approx(want)


def test_embedding_scores_against_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = {w: rng.normal(size=5) for w in "abcdef"}
    mean = np.mean(list(vectors.values()), axis=0)
    table = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in vectors.items()], "token string, vector array<double>")
    rows = [(1, "a b b c", ["a d", "c c zz"]), (2, "f e", ["b", "e f f"])]
    found = X.token_vectors(frame(spark, rows), table).cache()

    def cos(a, b):
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    def vec(t):
        return np.array([vectors.get(w, mean) for w in t.split()])

    def extreme(m):
        hi, lo = m.max(axis=0), m.min(axis=0)
        return np.where(lo == 0, lo, np.where((lo > 0) | (hi > -lo), hi, lo))

    def greedy(a, b):
        s = np.array([[cos(x, y) for y in b] for x in a])
        return (s.max(axis=0).mean() + s.max(axis=1).mean()) / 2

    for fn, name, one in (
        (X.emb_average, "emb_average", lambda a, b: cos(a.sum(axis=0), b.sum(axis=0))),
        (X.emb_extrema, "emb_extrema", lambda a, b: cos(extreme(a), extreme(b))),
        (X.emb_greedy, "emb_greedy", greedy),
    ):
        got = {r["id"]: r[name] for r in fn(found).collect()}
        for i, h, refs in rows:
            assert got[i] == pytest.approx(max(one(vec(h), vec(r)) for r in refs)), name


def test_scored_files(spark, tmp_path):
    for name, lines in {"hyp": ["a b", "c"], "r1": ["a", "c d"], "r2": ["b", "x"]}.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    df = X.read_scored_files(spark, str(tmp_path / "hyp"), [str(tmp_path / "r1"), str(tmp_path / "r2")])
    assert sorted(map(tuple, df.collect())) == [(1, "a b", ["a", "b"]), (2, "c", ["c d", "x"])]
    assert math.isclose(X.bleu_corpus(df, 1).first()[0], 1.0, rel_tol=1e-6)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ngrams_of_a_row_are_counted_inside_it(spark):
    rows = [(1, "a b a b"), (2, ""), (3, None), (4, "a"), (None, "x y"), (7, "k l"), (None, "x z"), (7, "k l m")]
    made = lambda part: X.gram_counts(spark.createDataFrame(part, "id long, t string"), ["id"], F.split("t", " "), 2)
    assert "Exchange" not in _plan(made(rows[:5]))
    want = {}
    for key, text in rows:
        words = [] if text is None else text.split(" ")
        for k in (1, 2):
            for i in range(len(words) - k + 1):
                at = (key, k, " ".join(words[i : i + k]))
                want[at] = want.get(at, 0) + 1
    got = [tuple(x) for x in made(rows).collect()]
    assert len(got) == len(want) and {x[:3]: x[3] for x in got} == want


def test_matches_need_no_shuffle_of_ngrams_and_repeated_ids_add_up(spark):
    rows = [(1, "a b a", ["a a c", "b"]), (2, None, ["x"]), (3, "x", [None]), (4, "", [""]), (5, "p q", []), (None, "n", ["n"])]
    got = X.clipped_matches(frame(spark, rows), 2)
    assert "Exchange" not in _plan(got)
    want = {(1, 1): 3, (1, 2): 0, (2, 1): 0, (3, 1): 0, (5, 1): 0, (5, 2): 0, (None, 1): 1}
    assert {(x.id, x.n): x.correct for x in got.collect()} == want
    twice = rows + [(1, "a", ["a"]), (None, "n m", ["n m", "o"])]
    got = {(x.id, x.n): x.correct for x in X.clipped_matches(frame(spark, twice), 2).collect()}
    # id 1: a three times against at most three in the first reference, b once; null: n twice, m and "n m" once
    assert got == {**want, (1, 1): 4, (None, 1): 3, (None, 2): 1}
