"""Merkle manifest of a table as a postorder append log.

Every tree (one per value of a column, one above them) has runs of ``FAN`` nodes; a run's hash is the hash of its digests
as hex text. A builder takes an aligned stretch of ``FAN ** RISE`` nodes, that is a whole subtree, and appends nodes in the order
in which they are completed: children, then their parent. The place of a node in that log is a closed form of its level, its
index and the number of leaves, so a proof reads siblings by address and nothing is searched. The last digest of a stretch is a
leaf of the next round; a tree of n leaves takes log(n) / log(729) rounds. A task holds one stretch, whatever the sizes of trees.

Rows are ordered by key (null first) and digest, so rows with one key have a defined order and equal rows are interchangeable.
A null tree name is a tree of its own, before all others. An empty table has no nodes. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import running_sums
from ..plans.session import materialise

FAN = 3
#: Levels that a builder folds: a stretch is 729 nodes.
RISE = 6
STRETCH = FAN**RISE
_PATH = "lefts array<string>, rights array<string>"


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Hash of a row: each field as its length in UTF-8 bytes, a colon and its text, or a dash where it is null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def position(level: int, index, leaves: int):
    """Place of a node in the postorder log of a tree. Before the last leaf of the node's subtree (``last``) are ``last``
    leaves and, of every level m, ``last // FAN ** m`` finished nodes; behind it come its ancestors up to the node."""
    last = np.minimum((np.asarray(index, "i8") + 1) * FAN**level, leaves) - 1
    place, step = last + level, FAN
    while step < leaves:
        place, step = place + last // step, step * FAN
    return place


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def fold_stretch(leaves: Sequence[str], rise: int) -> list[str]:
    """Digests of a stretch in completion order."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(rise + 1)]
    for i, digest in enumerate(leaves):
        log.append(digest)
        runs[0].append(digest)
        level = 0
        while level < rise and (len(runs[level]) == FAN or i == len(leaves) - 1):
            digest = digest_of("".join(runs[level]))
            log.append(digest)
            runs[level].clear()
            level += 1
            runs[level].append(digest)
    return log


def sibling_paths(log: Sequence[str], leaves: int, rise: int):
    """(left, right) digests of the siblings per level, for every leaf of a stretch, read from the log by address."""
    places = [position(level, np.arange(-(-leaves // FAN**level)), leaves).tolist() for level in range(rise)]
    for i in range(leaves):
        lefts, rights = [], []
        for at in places:
            first = i - i % FAN if at is places[0] else j - j % FAN
            here = i if at is places[0] else j
            lefts.append("".join(log[p] for p in at[first:here]))
            rights.append("".join(log[p] for p in at[here + 1 : first + FAN]))
            j = here // FAN
        yield lefts, rights


def fold_path(digest: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights):
        digest = digest_of(left + digest + right)
    return digest


@dataclass
class Forest:
    """``rounds[r]``: stretches (tree, block, n, log, keys, altered) of round r; ``n`` counts the tree's nodes in that round."""

    rounds: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(tree, root): the last digest of a tree's last log."""
        ends = [seg.filter(F.col("n") <= STRETCH).select("tree", F.col("log")[F.size("log") - 1].alias("root")) for seg in self.rounds]
        out = ends[0]
        for more in ends[1:]:
            out = out.unionByName(more)
        return out

    def nodes(self) -> DataFrame:
        """(tree, level, index, position, digest) of every node: the whole log, by its places."""
        import pyarrow as pa

        def lines(batches, r):
            for batch in batches:
                for tree, block, n, leaves, log in zip(*[batch.column(c).to_pylist() for c in ("tree", "block", "n", "leaves", "log")]):
                    own = min(STRETCH, n - block * STRETCH)
                    rise = RISE if n > STRETCH else height(n)
                    for level in range(1 if r else 0, rise + 1):
                        j = np.arange(-(-own // FAN**level))
                        index = block * FAN ** (RISE - level) + j if level < RISE else block + j
                        place = position(r * RISE + level, index, leaves)
                        digests = [log[p] for p in position(level, j, own)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree] * len(j), pa.string()), pa.array([r * RISE + level] * len(j), pa.int32()),
                             pa.array(index, pa.int64()), pa.array(place, pa.int64()), pa.array(digests, pa.string())],
                            ["tree", "level", "index", "position", "digest"],
                        )

        out = None
        for r, seg in enumerate(self.rounds):
            rows = seg.select("tree", "block", "n", "leaves", "log").mapInArrow(
                lambda b, r=r: lines(b, r), "tree string, level int, index long, position long, digest string"
            )
            out = rows if out is None else out.unionByName(rows)
        return out


def _build(rows: DataFrame) -> DataFrame:
    """Stretches of (tree, at, n, leaves, digest, key, altered) rows; ``at`` counts a tree's rows from 0."""
    import pyarrow as pa

    key_type = rows.schema["key"].dataType.simpleString()
    schema = f"tree string, block long, n long, leaves long, log array<string>, keys array<{key_type}>, altered array<string>"

    def builder(key, table):
        table = table.sort_by("at")
        n = table.column("n")[0].as_py()
        rise = RISE if n > STRETCH else height(n)
        log = fold_stretch(table.column("digest").to_pylist(), rise)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        keys = table.column("key").combine_chunks()
        return pa.table(
            {
                "tree": table.column("tree")[:1],
                "block": pa.array([key[1].as_py()], pa.int64()),
                "n": pa.array([n], pa.int64()),
                "leaves": table.column("leaves")[:1],
                "log": one(log, pa.string()),
                "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                "altered": one(table.column("altered").to_pylist(), pa.string()),
            }
        )

    blocks = rows.withColumn("block", F.expr(f"at div {STRETCH}"))
    return materialise(blocks.groupBy("tree", "block").applyInArrow(builder, schema))


def append_log(rows: DataFrame) -> Forest:
    """Logs of the trees of (tree, key, digest, altered) rows, ordered by key and digest within each tree."""
    one = rows.withColumn("__one", F.lit(1).cast("long"))
    run = running_sums(one, ["key", "digest"], ["__one"], ["tree"])
    at, n = F.col("cum___one") - 1, F.col("tot___one")
    level = run.select("tree", at.alias("at"), n.alias("n"), n.alias("leaves"), "digest", "key", "altered")
    rounds = [_build(level)]
    while True:
        open_trees = rounds[-1].filter(F.col("n") > STRETCH)
        if open_trees.isEmpty():
            return Forest(rounds)
        tops = open_trees.select(
            "tree",
            F.col("block").alias("at"),
            F.expr(f"(n + {STRETCH - 1}) div {STRETCH}").alias("n"),
            "leaves",
            F.col("log")[F.size("log") - 1].alias("digest"),
            F.col("block").alias("key"),
            F.lit(None).cast("string").alias("altered"),
        )
        rounds.append(_build(tops))


def _expand(segs: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, at, key, leaf, folded, lefts, rights) of every leaf of the stretches: its siblings here, then those of ``above``
    (tree, block, lefts, rights), and what its altered digest, or else its own, folds to along them."""
    import pyarrow as pa

    up = above.withColumnsRenamed({"tree": "__tree", "block": "__block"})
    on = F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("block") == F.col("__block"))
    key_type = segs.schema["keys"].dataType.elementType.simpleString()
    keys_at = ["tree", "block", "n", "log", "altered", "lefts", "rights"]

    def lines(batches):
        for batch in batches:
            for row, values in enumerate(zip(*[batch.column(c).to_pylist() for c in keys_at])):
                tree, block, n, log, altered, up_left, up_right = values
                keys = batch.column("keys")[row].values
                own = len(altered)
                paths = sibling_paths(log, own, RISE if n > STRETCH else height(n))
                leaves = [log[p] for p in position(0, np.arange(own), own)]
                lefts, rights, folded = [], [], []
                for leaf, other, (a, b) in zip(leaves, altered, paths):
                    lefts.append(a + up_left)
                    rights.append(b + up_right)
                    folded.append(fold_path(leaf if other is None else other, lefts[-1], rights[-1]))
                text = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * own, pa.string()), pa.array(block * STRETCH + np.arange(own), pa.int64()), keys,
                     pa.array(leaves, pa.string()), pa.array(folded, pa.string()), pa.array(lefts, text), pa.array(rights, text)],
                    ["tree", "at", "key", "leaf", "folded", "lefts", "rights"],
                )

    joined = segs.join(up, on).select(*keys_at, "keys")
    return joined.mapInArrow(lines, f"tree string, at long, key {key_type}, leaf string, folded string, {_PATH}")


def proofs(forest: Forest, above: DataFrame) -> DataFrame:
    """Proof of every leaf of a forest, whose roots' own proofs are ``above`` (tree, lefts, rights): rounds from the top down."""
    known = None
    for seg in reversed(forest.rounds):
        mine = above.select("tree", F.lit(0).cast("long").alias("block"), "lefts", "rights")
        up = mine if known is None else _roots_first(known, mine)
        known = _expand(seg, up)
    return known


def _roots_first(known: DataFrame, mine: DataFrame) -> DataFrame:
    """Paths of the blocks of a round: those found one round higher, and the root's own path for trees that ended here."""
    settled = materialise(known.select("tree", F.col("at").alias("block"), "lefts", "rights"))
    ended = mine.join(settled.select(F.col("tree").alias("__t")).distinct(), F.col("tree").eqNullSafe(F.col("__t")), "left_anti")
    return settled.unionByName(ended)


def manifest(docs: DataFrame, key: str, tree: str, fields: Sequence[str], altered: Column | None = None) -> DataFrame:
    """(key, tree, leaf, subroot, root, lefts, rights, folded) of every row of ``docs``: its digest over ``fields``, the root of
    its tree, the root over all trees (ordered by name), the siblings level by level up to that root, and the root that folding
    gives from ``altered`` (a digest, null for the row's own). ``lefts[i] || digest || rights[i]`` is what level i + 1 hashes."""
    other = F.lit(None).cast("string") if altered is None else altered
    rows = docs.select(
        F.col(tree).cast("string").alias("tree"),
        F.col(key).alias("key"),
        leaf_digest(*[F.col(f) for f in fields]).alias("digest"),
        other.alias("altered"),
    )
    rows = materialise(rows)
    forest = append_log(rows)
    tops = materialise(forest.subroots())
    # the trees' roots are the leaves of one more tree, ordered by name
    named = tops.select(
        F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("altered")
    )
    crown = append_log(named)
    no_path = F.array().cast("array<string>")
    start = crown.subroots().select("tree", no_path.alias("lefts"), no_path.alias("rights"))
    paths = materialise(proofs(crown, start).select(F.col("key").alias("tree"), F.col("leaf").alias("subroot"), F.col("folded").alias("root"), "lefts", "rights"))
    found = proofs(forest, paths.select("tree", "lefts", "rights"))
    ends = paths.select(F.col("tree").alias("__tree"), "subroot", "root")
    out = found.join(ends, F.col("tree").eqNullSafe(F.col("__tree")))
    return out.select("key", "tree", "leaf", "subroot", "root", "lefts", "rights", "folded")
