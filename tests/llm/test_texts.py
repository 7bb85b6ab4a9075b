"""Text operators against brute force, with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import jaccard_join, line_dedup, lm_score, packing, quality_pu
from quarrymill.llm.components import components
from quarrymill.llm.exprs import crc_mod
from quarrymill.llm.license_scan import scan_licenses

from . import helpers

SCHEMA = "doc_id long, text string"


def corpus(seed, bases=40):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(800)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = [None, "", " \n\t ", "a", "A", "x" * 30_000, "b " * 4_000]
    for _ in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 20, 60, 150]))]
        if rng.random() < 0.3:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 2, 3, 25])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, len(t) // 40)])):
                k = rng.randrange(len(t))
                t[k : k + rng.choice([0, 1])] = [rng.choice(vocab)]
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small_group", [16, 2])
def test_near_duplicates(spark, monkeypatch, small_group):
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", small_group)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rows = corpus(small_group)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"fp": F.lit("x"), "n": F.lit(1), "component_id": F.lit(0)})
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(df).collect())
    assert got == helpers.near_copies(rows)


def test_near_duplicates_edges(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(7, "one two three four five six"), (7, "one two three four five six"), (None, "one two three four five six"), (9, None), (9, None)]
    got = sorted(map(str, (tuple(r) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(map(str, [(7, 2, 7), (7, 2, 7), (None, 2, 7), (9, 0, 9), (9, 0, 9)]))


def test_star_centres_agree_between_groups(spark):
    """Groups of one cluster, each with other members and another name, have the commonest member as their centre."""
    rng = random.Random(1)
    rows = [(g, n, 9 if n == 40 else rng.randint(1, 3)) for g in range(8) for n in {*rng.sample(range(8, 90), 30), g, 40}]
    pairs = jaccard_join._stars(spark.createDataFrame(rows, "g long, fp long, times long")).distinct().collect()
    assert {(r.a, r.b) for r in pairs} == {(min(n, 40), max(n, 40)) for _, n, _ in rows if n != 40}


def test_sketches_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 300).astype("u8"))
    b = np.r_[a[:250], rng.integers(0, 1 << 62, 400).astype("u8")]
    sketch = lambda s: jaccard_join.bit_sketches(s, np.zeros(len(s), "i8"), np.array([len(s)]))[0]
    assert jaccard_join.hamming(sketch(a), sketch(b)) <= len(set(a.tolist()) ^ set(b.tolist()))
    assert jaccard_join.hamming(sketch(a), sketch(a)) == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 99), (99, 98), (98, 100), (5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 98: 98, 99: 98, 100: 98}


def test_line_dedup(spark):
    rng = random.Random(2)
    common = ["This line stands in very many of the documents " + str(i) for i in range(6)]
    rows = [(0, None), (1, ""), (2, "\n\n")]
    for i in range(3, 120):
        lines = [f"line {i} {k} of its own, which is long enough to count" for k in range(2)]
        lines += [rng.choice(["", "  \t", ""]) + rng.choice([c, c.upper()]) + rng.choice(["", " \r"]) for c in common if rng.random() < 0.4]
        lines += ["short line"] * 2 + (["é" * 40] if i % 9 == 0 else ["é" * 39] if i % 9 == 1 else [])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n_lines": F.lit("x"), "h1": F.lit(1), "keeper": F.lit(2)})
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.dedup_lines(df, batches=5, fanout=2).collect()}
    assert got == helpers.keep_lines(rows)


def test_line_dedup_edges(spark):
    line = "the same line in each of these rows, and long enough"
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, line)] * 3 + [(4, line)] * 3 + [(2, f"{line}\nx")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text", "n_dropped").collect()
    assert sorted(map(str, got)) == sorted(map(str, [r for r in spark.createDataFrame(
        [(None, line, 0)] * 3 + [(4, line, 0)] * 3 + [(2, "x", 1)], "doc_id long, text string, n_dropped long").collect()]))


def test_line_runs_tell_fresh_keys(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    batch = lambda ids, keys: spark.createDataFrame([(i, k, k) for i in ids for k in keys], "doc_id long, h1 long, h2 long")
    runs.add(batch([9, 8], [1, 2]))
    second = {r.h1: r.keeper for r in runs.add(batch([7], [2, 3])).collect()}
    assert second == {2: None, 3: 7}
    assert len(runs.levels[0]) == 0 and len(runs.levels[1]) == 1
    assert {(r.h1, r.n, r.keeper) for r in runs.totals().collect()} == {(1, 2, 9), (2, 3, 9), (3, 1, 7)}


def test_license_scan(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [
        (1, None), (2, ""), (3, "CC BY cc-by CC  BY"), (4, "see the GNU General Public License or all rights reserved"),
        (5, f"x y z {mit} more"), (6, "permission granted charge obtaining copy associated documentation"),
        (7, "word " * 5000 + "general public license"), (8, "Licensed under the Apache License, Version 2.0"), (8, "Licensed under the Apache License, Version 2.0"),
    ]
    out = scan_licenses(spark.createDataFrame(rows, SCHEMA).withColumn("labels", F.lit(3)))
    got = {r.doc_id: (r.n_words, list(r.starts), ",".join(r.base_labels), ",".join(r.labels)) for r in out.collect()}
    assert got[1] == got[2] == (0, [], "", "")
    assert got[3] == (6, [0, 2, 4], "cc-by", "cc-by")
    assert got[4] == (10, [3, 7], "gpl,reserved", "gpl,reserved")
    assert got[5][3] == "mit" and got[6][3] == ""
    assert got[7] == (5003, [5000], "gpl", "gpl")
    assert got[8][2:] == ("", "apache") and out.count() == 9
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_license_notices_in_other_words(spark):
    rows = [
        (1, "Licensed under the MIT License"), (2, "# MIT License"), (3, "studied at mit without a license"),
        (4, "text before. The above copyright notice and this permission notice shall be included in all copies."),
        (5, "see the Apache License"), (6, "GNU is free"), (7, "released today"),
    ]
    got = {r.doc_id: r.labels for r in scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ["mit"], 2: ["mit"], 3: [], 4: ["mit"], 5: ["apache"], 6: [], 7: []}


def test_license_many_notices(spark):
    """A megabyte of notices: one match per notice; words are looked at by place, so the time does not grow with the square."""
    rows = [(1, "Licensed under the MIT License. " * 32_000), (2, "mit license"), (3, "under the license")]
    out = scan_licenses(spark.createDataFrame(rows, SCHEMA)).selectExpr("doc_id", "size(matches) AS n", "labels").collect()
    assert {r.doc_id: (r.n, r.labels) for r in out} == {1: (32_000, ["mit"]), 2: (1, ["mit"]), 3: (0, [])}


def test_lm_scores(spark):
    rng = random.Random(4)
    pairs = {f"a{i}": f"b{i}" for i in range(30)}
    rows = [(0, None), (1, ""), (2, "Word WORD\tword\x0bnew")]
    for i in range(3, 300):
        firsts = [rng.choice(list(pairs)) for _ in range(rng.randint(1, 60))]
        rows.append((i, " ".join(f"{a} {pairs[a]}" for a in firsts) + f" rare{i}"))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"number": F.lit(1), "training": F.lit("x")})
    got = {r.doc_id: r for r in lm_score.score_texts(df, crc_mod(F.col("doc_id"), 7) != 2).collect()}
    import zlib

    expected = helpers.unigram([(i, t, zlib.crc32(str(i).encode()) % 7 != 2) for i, t in rows])
    assert got.keys() == expected.keys()
    for i, (n, known, total, base) in expected.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [i for i in expected if zlib.crc32(str(i).encode()) % 7 == 2]
    # the second word of a pair follows from the first, which only the model with a context can tell
    assert sum(got[i].score for i in held) > 0.8 * sum(got[i].base_score for i in held)


def test_lm_edges(spark):
    assert lm_score.score_texts(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], SCHEMA)
    got = lm_score.score_texts(rows, F.col("doc_id") == 5).collect()
    assert len(got) == 3 and all(r.train_tokens == 0 and r.n_known == 0 for r in got)
    import math

    assert all(math.isfinite(r.score) for r in got)


def test_lm_learns_alike_from_any_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm_score, "LEAST_TEXT", 20_000)
    monkeypatch.setattr(lm_score, "TEXT_A_WORD", 0)
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, "x " * 9_000)]
    for i in range(3, 400):
        firsts = [rng.randrange(60) for _ in range(30)]
        rows.append((i, "the same text for a third of all rows" if i % 3 == 0 else " ".join(f"a{k} b{k}" for k in firsts)))
    found = []
    for files in (1, 7):
        spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(f"{tmp_path}/{files}")
        docs = spark.read.parquet(f"{tmp_path}/{files}")
        found.append({r.doc_id: r for r in lm_score.score_texts(docs, F.col("doc_id") % 5 != 2).collect()})
    one, many = found
    assert one.keys() == many.keys() == {i for i, _ in rows}
    for i, r in one.items():
        assert many[i].score == pytest.approx(r.score, rel=1e-4)
        assert many[i].base_score == pytest.approx(r.base_score, rel=1e-9)
    held = [i for i in one if i % 5 == 2]
    assert sum(one[i].score for i in held) > sum(one[i].base_score for i in held)


def test_lm_tells_rare_words_apart(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        firsts = [rng.randrange(300) for _ in range(30)]
        rows.append((i, " ".join(f"a{k} b{k}" for k in firsts)))
    # as often in the corpus, but the second words do not belong to the first
    rows += [(1000, " ".join(f"a{k} b{k}" for k in range(250, 300))), (1001, " ".join(f"a{k} b{k - 7}" for k in range(257, 300)) + " " + " ".join(f"a{250 + k} b{293 + k}" for k in range(7)))]
    got = {r.doc_id: r for r in lm_score.score_texts(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") < 1000).collect()}
    assert got[1000].base_score == pytest.approx(got[1001].base_score)
    assert got[1000].score > got[1001].score + 10


def test_lm_memory_a_token_and_python_processes_a_task(spark):
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(3)
    n = 100_000
    model = lm_score.LogBilinear(500)
    before, last, ids = rng.integers(0, 500, (3, n))
    for work, most in ((lambda: model.step(before, last, ids, np.ones(n, "f4"), np.zeros(len(model.m), "f4")), 400), (lambda: model.log_prob(before, last, ids), 250)):
        tracemalloc.start()
        work()
        assert tracemalloc.get_traced_memory()[1] / n < most
        tracemalloc.stop()
    rows = [(i, "a b c d " * 20) for i in range(50)]
    out = lm_score.score_texts(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("FlatMapGroupsInPandas") == 1  # of texts; of sums, whose rows need no second process


def test_lm_ids_before():
    import numpy as np

    two, one = lm_score._before(np.array([3, 4, 5, 9, 9, 3, 9, 4, 4, 9]), 10)  # an empty text is an end alone
    assert one.tolist() == [9, 3, 4, 5, 9, 9, 3, 9, 4, 4] and two.tolist() == [9, 9, 3, 4, 9, 9, 9, 9, 9, 4]


def test_log_bilinear_is_normalised():
    import numpy as np

    model = lm_score.LogBilinear(10).fit(np.array([5, 123, 999]), np.array([3.0, 2.0, 1.0]), steps=5)
    assert np.allclose(np.exp(model.log_probs()).sum(1), 1)


def test_packing(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 7, 300, 512, 513, 4096, 9000, 20_000])) for i in range(3000)] + [(5000, None), (5001, 0), (5002, -3), (None, 9), (0, 7)]
    df = spark.createDataFrame(rows, "doc_id long, n long").withColumns({"key": F.lit(1), "piece": F.lit(2), "shard": F.lit(3)})
    out = packing.pack_lengths(df, "doc_id", "n").toPandas()
    assert out["n_tokens"].sum() == sum(max(n or 0, 0) for _, n in rows)
    none = out[out["bin_id"].isna()]
    assert sorted(none["doc_id"]) == [5000, 5001, 5002] and (none["n_tokens"] == 0).all()
    used = 0
    for _, b in out.dropna(subset=["bin_id"]).groupby("bin_id"):
        b = b.sort_values("start")
        assert (b["start"].to_numpy()[1:] == (b["start"] + b["n_tokens"]).to_numpy()[:-1]).all() and b["start"].iloc[0] == 0
        total, capacity = b["n_tokens"].sum(), int(b["capacity"].iloc[0])
        assert total <= capacity and (b["bin_used"] == total).all()
        assert capacity == min(c for c in packing.CAPACITIES if c >= total)  # downsized
        used += capacity
    assert used <= out["n_tokens"].sum() * 1.01 + max(packing.CAPACITIES)
    assert packing.pack_lengths(spark.createDataFrame([], "doc_id long, n long"), "doc_id", "n").count() == 0


def test_best_fit_choice():
    placed, bins = packing.pack([6, 5, 4, 3, 2], [8, 16], overhead=0)
    assert sum(c for _, c in bins) == 24 and [u for u, _ in bins] and len(placed) == 5
    assert packing.pack([], [8])[1] == []
    assert packing.pack([3], [4, 8], overhead=1)[1] == [(3, 4)]  # the small bin costs less for what is left


def plain_best_fit(lengths, capacities, overhead, attention):
    """The rule of ``pack`` over plain lists."""
    bins, placed = [], []  # a bin: used, room, when it was last filled
    waiting, promised = list(lengths), []
    for i, n in enumerate(lengths):
        fitting = [b for b in range(len(bins)) if bins[b][1] - bins[b][0] >= n]
        from_promised = n in promised and (fitting or n not in waiting)
        (promised if from_promised else waiting).remove(n)
        if not fitting:
            offers = []
            for c in sorted(capacities):
                if c >= n:
                    plan = []
                    for later in sorted(waiting, reverse=True):
                        if n + sum(plan) + later <= c:
                            plan.append(later)
                    offers.append((packing.price(c, overhead, attention) / (n + sum(plan)), c, plan))
            _, c, plan = min(offers)
            for x in plan:
                waiting.remove(x)
            promised += plan
            bins.append([0, c, -1])
            fitting = [len(bins) - 1]
        b = min(fitting, key=lambda b: (bins[b][1] - bins[b][0], -bins[b][2]))
        placed.append((b, bins[b][0]))
        bins[b][0] += n
        bins[b][2] = i
    return placed, [(u, min(c for c in capacities if c >= u)) for u, _, _ in bins]


def test_best_fit_against_plain_lists():
    rng = random.Random(3)
    for _ in range(60):
        capacities = sorted(rng.sample([8, 12, 16, 32, 64, 100], 3))
        lengths = sorted((rng.randint(1, capacities[-1]) for _ in range(rng.randint(0, 80))), reverse=True)
        overhead, attention = rng.choice([0, 2, 9]), rng.choice([20, 100, 1000])
        assert packing.pack(lengths, capacities, overhead, attention) == plain_best_fit(lengths, capacities, overhead, attention)


def test_lengths_are_chosen_jointly():
    rng = random.Random(4)
    lengths = sorted((int(min(8192, rng.lognormvariate(5.5, 1.3)) + 1) for _ in range(20_000)), reverse=True)
    lengths = [min(n, 8192) for n in lengths]
    cost = lambda bins: sum(packing.price(min(c for c in packing.CAPACITIES if c >= u)) for u, _ in bins)
    placed, bins = packing.pack(lengths)
    early = [c for _, c in bins[: len(bins) // 2]]
    assert len({c for c in early}) > 1  # several sizes are opened long before the end
    tokens, capacity = sum(lengths), sum(c for _, c in bins)
    assert capacity <= 1.01 * tokens
    for one in packing.CAPACITIES:
        if one >= lengths[0]:
            assert cost(bins) < 0.95 * cost(packing.pack(lengths, [one])[1])


def test_count_tokens(spark):
    rows = [(1, None), (2, ""), (3, " a  b\tc\n"), (4, "é"), (5, "x" * 100_000)]
    out = packing.count_tokens(spark.createDataFrame(rows, SCHEMA).withColumn("n_tokens", F.lit("x")))
    assert {r.doc_id: r.n_tokens for r in out.collect()} == {1: 1, 2: 1, 3: 4, 4: 2, 5: 2}


def test_quality(spark):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["sea", "hill", "the", "walks", "river", "of", "cloud"]) + rng.choice(["", "", "s"]) for _ in range(40)) + "."
    bad = lambda: " ".join(rng.choice(["sea", "hill", "the"]) + rng.choice(["%%%", "***", "###"]) for _ in range(40))
    rows = [(i, good() if i % 4 else bad()) for i in range(800)] + [(900, None), (901, ""), (None, good()), (5, good())]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 800, 2)] + [(4, 0), (None, 1)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"f0": F.lit(1.0), "positive": F.lit(True), "score": F.lit(0)})
    out = quality_pu.score_quality(df, labels, crc_mod(F.col("doc_id"), 3) != 1).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    right = [r.predicted == int(r.doc_id % 4 > 0) for r in out if r.doc_id is not None and r.doc_id < 800 and r.doc_id != 5]
    assert sum(right) >= 0.98 * len(right)
    kept = quality_pu.accepted(df.select("doc_id", "text"), labels, crc_mod(F.col("doc_id"), 3) != 1, ["doc_id", "text"])
    assert kept.count() == sum(r.predicted for r in out)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    out = quality_pu.score_quality(spark.createDataFrame([(1, "a"), (2, None)], SCHEMA), labels, F.lit(True)).collect()
    assert {(r.doc_id, r.score, r.predicted) for r in out} == {(1, 0.5, 1), (2, 0.5, 1)}
    assert quality_pu.score_quality(spark.createDataFrame([], SCHEMA), labels, F.lit(True)).count() == 0
