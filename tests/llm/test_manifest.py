"""The postorder manifest against a plain fold over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import merkle_manifest as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, i):
    """[(digests left of the node, digests right of it)] level by level."""
    out = []
    for row in tree[:-1]:
        first = i - i % 3
        out.append((row[first:i], row[i + 1 : first + 3]))
        i //= 3
    return out


def brute(rows):
    rows = [r[:5] for r in rows]
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        trees.setdefault(r[1], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels([leaf(r) for r in trees[s]]) for s in names}
    crown = levels([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(trees[s]):
            path = climb(built[s], i) + climb(crown, k)
            bare = r if r[4] is None or zlib.crc32(str(r[0]).encode()) % 2 or r[0] is None else (*r[:4], r[4].replace("\n", ""))
            digest = leaf(bare)
            for a, b in path:
                digest = sha("".join(a) + digest + "".join(b))
            proof = sha("".join("".join(a + b) for a, b in path))
            out.append((r[0], leaf(r), built[s][-1][0], crown[-1][0], proof, digest, digest == crown[-1][0]))
    return sorted(out, key=repr)


def digests(df):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    out = M.manifest(df, "doc_id", "source", FIELDS, F.when(even, M.leaf_digest(*[F.col(c) for c in FIELDS[:-1]], bare)))
    proof = F.sha2(F.concat_ws("", F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b))).cast("binary"), 256)
    out = out.select("key", "leaf", "subroot", "root", proof, "folded", F.col("folded") == F.col("root"))
    return sorted([tuple(r) for r in out.collect()], key=repr)


def odd_rows():
    rows = [(i, f"s{i % 4}", "en", i, f"line {i}\nnext", "clash") for i in range(40)]
    rows += [(100, None, None, None, None, None), (101, None, "de", 2, "", ""), (None, "s0", "fr", 3, "a\nb", "x")]
    rows += [(7, "s3", "en", 7, "line 7\nnext", "again"), (7, "s3", "en", 7, "other", "again")]  # repeated row, repeated key
    rows += [(200, "é", "en", 1, "long " * 50_000, ""), (201, "Z", "en", 1, "one leaf", ""), (202, "", "en", 1, "\n\n", "")]
    return rows


@pytest.mark.parametrize("rise", [1, 2, 6])
def test_manifest_matches_a_plain_fold(spark, monkeypatch, rise):
    monkeypatch.setattr(M, "RISE", rise)
    monkeypatch.setattr(M, "STRETCH", 3**rise)
    rows = odd_rows()
    if rise == 6:
        rows += [(i, "hot", "en", i, f"text {i}", "") for i in range(1000, 1800)]  # two stretches of 729
    assert digests(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_positions_are_the_completion_order(leaves):
    rise = M.height(leaves)
    tree = levels([str(i) for i in range(leaves)])
    log = M.fold_stretch(tree[0], rise)
    assert len(log) == sum(map(len, tree))
    for level, row in enumerate(tree):
        assert [log[p] for p in M.position(level, range(len(row)), leaves)] == row


def test_log_lists_every_node_once_in_postorder(spark, monkeypatch):
    monkeypatch.setattr(M, "RISE", 1)
    monkeypatch.setattr(M, "STRETCH", 3)
    rows = [("t" if i % 3 else None, i, sha(str(i)), None) for i in range(60)]
    forest = M.append_log(spark.createDataFrame(rows, "tree string, key long, digest string, altered string"))
    found = forest.nodes().collect()
    for name in ("t", None):
        tree = levels([r[2] for r in rows if r[0] == name])
        mine = sorted((n for n in found if n["tree"] == name), key=lambda n: n["position"])
        assert [n["position"] for n in mine] == list(range(sum(map(len, tree))))
        assert [n["digest"] for n in mine] == M.fold_stretch(tree[0], len(tree) - 1)
        assert all(n["digest"] == tree[n["level"]][n["index"]] for n in mine)
