"""The byte network: gradients against differences, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from quarrymill.llm import byte_gru as G
from quarrymill.llm.exprs import crc_mod
from tests.oracle import DATA

SCHEMA = "doc_id long, text string, lang string, source string, score double, __text string"


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = G.fresh(["a", "b", "c"], hidden=3)
    lengths = [7, 4, 1]
    x = rng.integers(97, 101, (7, 3)).astype("u1")
    mask = (np.arange(7)[:, None] < np.array(lengths)[None, :]).astype("f4")
    y = np.array([0, 2, 1])
    _, grads = G.gradients(net, x, mask, y)
    for p, g in zip(net.parameters(), grads):
        spots = np.argsort(-np.abs(g).ravel())[:4]
        for spot in spots:
            at = np.unravel_index(spot, p.shape)
            old, step = p[at], np.float32(1e-2)
            losses = []
            for value in (old + step, old - step):
                p[at] = value
                losses.append(G.gradients(net, x, mask, y)[0])
            p[at] = old
            assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(g[at], rel=0.03, abs=2e-4)


def test_pooling_is_the_mean_over_all_bytes(monkeypatch):
    monkeypatch.setattr(G, "WINDOW", 5)
    monkeypatch.setattr(G, "SIDE_BY_SIDE", 3)
    net = G.fresh(["a", "b"], hidden=3)
    texts = [b"", b"abc", b"abcdefghijklm", b"x", b"", b"abcde"]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    found = G.pool(net, np.frombuffer(b"".join(texts), "u1"), offsets)
    for text, row in zip(texts, found):
        p = [G.position_probabilities(net, np.frombuffer(text[i : i + 5], "u1")[:, None]) for i in range(0, len(text), 5)]
        want = np.concatenate(p).mean(axis=0)[:, 0] if p else np.zeros(2)
        assert row == pytest.approx(want, abs=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    held = crc_mod(F.col("doc_id"), 4) == 2
    rows = G.identify_languages(docs, ~held).join(docs.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert len(rows) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 and abs(sum(r["probabilities"]) - 1) < 1e-4 for r in rows)


def test_odd_rows(spark):
    rows = [(i, t, l, "s", 0.0, "x") for i, (t, l) in enumerate([("the cat and the dog sat", "en"), ("der Hund und die Katze", "de")] * 20)]
    rows += [(100, None, "en", None, None, None), (101, "", "en", "", 1.0, ""), (102, "12 !?", None, "", 1.0, ""), (103, "the dog " * 60_000, None, "", 1.0, "")]
    rows += [(None, "the cat and the dog", None, "", 1.0, ""), (104, "日本語", None, "", 0.0, ""), (0, "the cat and the dog sat", "en", "s", 0.0, "again")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = G.identify_languages(df, F.coalesce(F.col("doc_id") < 30, F.lit(False))).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103]["lang_pred"] == by[None]["lang_pred"] == "en" and by[39]["lang_pred"] == "de"
    assert by[104]["lang_pred"] in ("de", "en")
    same = [r["score"] for r in out if r["doc_id"] == 0]
    assert len(same) == 2 and same[0] == same[1]
    assert G.identify_languages(df.limit(0), F.lit(True)).collect() == []
    nothing = G.identify_languages(df, F.lit(False)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == len(rows)
    one = G.identify_languages(df, F.col("lang") == "en").collect()
    assert {r["lang_pred"] for r in one} == {"en", "und"}
