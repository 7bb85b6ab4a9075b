"""The splitter-skeleton trie against a dictionary of prefixes."""

from collections import defaultdict
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, key string, c string, n long"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        leaves[path] += not children[path]
        saved[path] += (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        if path:
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    c = F.col("c")
    crc = F.crc32(c.cast("string").cast("binary")) % 9
    out = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), c - c % 5, crc, 8)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in out.collect()], key=repr)


def made(seed, convs, longest, texts):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts), "x", "y", 1))
    return rows


@pytest.mark.parametrize("segment", [2, 64])
def test_trie_matches_prefix_dictionary(spark, monkeypatch, segment):
    monkeypatch.setattr(P, "SEGMENT", segment)
    monkeypatch.setattr(P, "SHARD_ROWS", 20)
    monkeypatch.setattr(P, "PIECE", 3)
    rows = made(1, 120, 9, ["a", "bé", "", None])
    rows += [(c, t, "user", f"copy {t}", "", "", 0) for c in range(1000, 1300, 5) for t in range(4)]  # a large group of copies
    rows += [(2000, None, "user", "first", "", "", 0), (2000, 1, "user", "then", "", "", 0), (2000, 1, "user", "then", "", "", 0)]
    rows += [(None, 0, "user", "no conversation", "", "", 0), (3001, 0, "user", "long " * 20_000, "", "", 0)]
    assert found(spark, rows) == brute(rows)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", 5)
    monkeypatch.setattr(P, "SHARD_ROWS", 10)
    rows = []
    for c in (0, 1, 2, 3, 4, 5, 6, 10, 11):
        cut = 17 + c  # equal beginnings, different ends
        rows += [(c, t, "user", f"turn {t}" if t < cut else f"own {c} {t}", "", "", 0) for t in range(40 if c % 2 else 20)]
    rows += [(15, t, "user", f"turn {t}", "", "", 0) for t in range(15)]  # ends where a segment ends
    rows += [(20, t, "user", f"turn {t}", "", "", 0) for t in range(15)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
