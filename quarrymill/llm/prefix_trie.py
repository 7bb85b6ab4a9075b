"""Trie of the shared beginnings of conversations, by a splitter skeleton.

A turn is a 128-bit digest of its role and text, a conversation the string of its digests, cut into segments of ``SEGMENT`` turns, so
that no row grows with a conversation. Segments are ordered by (number, what came before, path, conversation); a sample gives the
splitters of a range partition. Members of a node lie next to each other in that order, so a node whose members lie in two shards
is a beginning of a splitter's path: those nodes are the skeleton, and the splitters' paths are broadcast (one path of at most
``SEGMENT`` digests per shard). Each shard walks its sorted rows once with a stack and finishes every other node; for a skeleton
node it returns what it has seen, and these partial aggregates are summed per node, then up the skeleton. Copies of one
conversation are told apart by their number in the order, so a large group of copies is spread over shards.

What came before a segment is the sum of the hashes of all earlier (place, turn) pairs, found by running sums. What lies below
a segment's last turn belongs to the smallest conversation that goes on there, is summed from its end backwards, and added
to the nodes on that conversation's path; conversations within one segment have nothing to add.

Null roles and texts are empty; turns are ordered by (turn, digest), nulls first; rows without a conversation take no part. An
empty table has no nodes. Two different turns count as one with a probability of 2^-128 a pair, two beginnings longer than a
segment likewise.
"""

from __future__ import annotations

from bisect import bisect_right
import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import running_sums
from ..plans.session import materialise
from ..plans.skew import lookup_join

SEGMENT = 64
#: Rows of a shard, sampled rows per splitter, and ids in one piece of a skeleton node's list of endings.
SHARD_ROWS, PER_SPLITTER, PIECE = 20_000, 16, 1024
_RAW = (
    "what int, shard int, seq int, k int, depth long, node string, parent string, p string, next string, conv long, parent_conv long, "
    "n long, size long, children long, leaves long, saved long, ends string, up array<string>"
)
_FIELDS = [part.split()[0] for part in _RAW.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits that stand for a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)


def number_turns(conversations: DataFrame) -> DataFrame:
    """(c, i, n, key, size): turns of (conv_id, turn, role, text) rows, counted from 1; ``size`` in UTF-8 bytes."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").alias("t"),
        turn_digest(F.col("role"), F.col("text")).alias("key"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
    )
    run = running_sums(materialise(rows), ["t", "key"], ["one"], ["c"])
    return materialise(run.select("c", F.col("cum_one").alias("i"), F.col("tot_one").alias("n"), "key", "size"))


def rebuild(turns: DataFrame, donor: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with the first ``taken`` turns of conversation ``donor`` (columns over ``c``; at most ``most`` turns) in
    place of its own: ((c, length) of all, (c, pos, key, size, length) of their turns)."""
    item = F.struct("i", "key", "size")
    heads = turns.filter(F.col("i") <= most).groupBy("c").agg(F.sort_array(F.collect_list(item)).alias("head"))
    convs = turns.groupBy("c").agg(F.max("n").alias("n")).withColumn("b", donor).withColumn("h", taken)
    convs = convs.join(heads.withColumnRenamed("c", "b"), "b", "left")
    head = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.slice("head", 1, 0), F.array().cast(heads.schema["head"].dataType))
    convs = convs.withColumn("head", F.when(F.col("head").isNull(), F.array().cast(heads.schema["head"].dataType)).otherwise(head))
    convs = convs.withColumn("m", F.size("head").cast("long"))
    convs = materialise(convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("b"))
    first = convs.select("c", "length", F.posexplode("head").alias("at", "x"))
    first = first.select("c", (F.col("at") + 1).cast("long").alias("pos"), "x.key", "x.size", "length")
    side = convs.select("c", "h", "m", "length", "n")
    own = lookup_join(turns.drop("n"), side, ["c"], "inner", ["i"], side, "n")
    own = own.filter("i > h").select("c", (F.col("m") + F.col("i") - F.col("h")).alias("pos"), "key", "size", "length")
    return convs.select("c", "length"), first.unionByName(own)


def segments(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(k, p, c, path, sizes, next): pieces of at most ``SEGMENT`` turns, what came before and, where turns follow, after them."""
    at = F.expr(f"cast((pos - 1) div {SEGMENT} as int)").alias("k")
    codes = [F.xxhash64("pos", "key"), F.xxhash64("key", "pos", F.lit(7))]
    sums = [F.sum(x.cast("decimal(20,0)")).alias(f"s{j}") for j, x in enumerate(codes)]
    items = F.sort_array(F.collect_list(F.struct("pos", "key", "size")))
    cut = turns.groupBy("c", at).agg(F.max("length").alias("length"), items.alias("items"), *sums)
    keys, sizes = F.transform("items", lambda x: x["key"]), F.transform("items", lambda x: x["size"])
    cut = materialise(cut.select("c", "k", "length", F.unhex(F.array_join(keys, "")).alias("path"), sizes.alias("sizes"), "s0", "s1"))
    alone = cut.filter(F.col("length") <= SEGMENT).select("k", F.lit("").alias("p"), "c", "path", "sizes", F.lit(None).cast("string").alias("next"))
    run = running_sums(cut.filter(F.col("length") > SEGMENT), ["k"], ["s0", "s1"], ["c"], totals=False)
    code = lambda a, b: F.concat(a.cast("string"), F.lit(":"), b.cast("string"))
    before = code(F.col("cum_s0") - F.col("s0"), F.col("cum_s1") - F.col("s1"))
    goes_on = (F.col("k") + 1) * SEGMENT < F.col("length")
    chained = run.select(
        "k",
        F.when(F.col("k") > 0, before).otherwise("").alias("p"),
        "c",
        "path",
        "sizes",
        F.when(goes_on, code(F.col("cum_s0"), F.col("cum_s1"))).alias("next"),
    )
    bare = convs.filter("length = 0").select(
        F.lit(0).alias("k"), F.lit("").alias("p"), "c", F.lit(b"").alias("path"), F.array().cast("array<bigint>").alias("sizes"), F.lit(None).cast("string").alias("next")
    )
    return materialise(alone.unionByName(chained).unionByName(bare))


def _id(k: int, p: str, prefix: bytes) -> str:
    return hashlib.blake2b(b"%d|%s|" % (k, p.encode()) + prefix, digest_size=16).hexdigest()


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    most, m = min(len(a), len(b)) // 16, 0
    while m < most and a[16 * m : 16 * m + 16] == b[16 * m : 16 * m + 16]:
        m += 1
    return m


class _Node:
    __slots__ = ("n", "conv", "size", "children", "leaves", "saved", "ends", "first", "ids", "next", "bridge", "waiting")

    def __init__(self, size: int, bridge: bool):
        self.n, self.conv, self.size, self.children, self.leaves, self.saved = 0, None, size, 0, 0, 0
        self.ends, self.first, self.ids, self.next, self.bridge, self.waiting = None, True, None, None, bridge, []


class _Walk:
    """One shard: rows in order, a stack of the nodes on the current path, rows of closed nodes in ``out``."""

    def __init__(self, splitters):
        self.splitters, self.out, self.stack, self.place, self.path = splitters, [], [], None, b""
        self.seq = 0

    def row(self, shard, k, p, c, path, sizes, next_):
        place = (shard, k, p)
        if place != self.place:
            self.close(0)
            self.place, self.path = place, b""
            # only the splitters on both sides of the shard can share a node with it
            near = [s for s in self.splitters[max(0, shard - 1) : shard + 1] if s[:2] == (k, p)]
            self.near = [s[2] for s in near]
            self.stack = [_Node(0, bool(near))]
            self.names = [_id(k, p, b"")]
        keep = _shared(self.path, path)
        self.close(keep + 1)
        deepest = max((_shared(s, path) for s in self.near), default=-1)
        for d in range(keep + 1, len(path) // 16 + 1):
            self.stack.append(_Node(sizes[d - 1], d <= deepest))
            self.names.append(_id(k, p, path[: 16 * d]))
        self.path = path
        end = self.stack[-1]
        end.n += 1
        end.conv = c if end.conv is None else min(end.conv, c)
        if next_ is not None:
            end.next = next_
        elif end.bridge:
            end.ids = end.ids or []
            end.ids.append(str(c))
            if len(end.ids) >= PIECE:
                self.piece(end, self.names[-1])
        else:
            end.ends = end.ends or hashlib.sha256()
            end.ends.update((b"" if end.first else b",") + b"%d" % c)
            end.first = False

    def piece(self, node, name):
        self.seq += 1
        row = dict.fromkeys(_FIELDS)
        row.update(what=2, shard=self.place[0], seq=self.seq, node=name, ends=",".join(node.ids))
        self.out.append(row)
        node.ids = []

    def close(self, down_to):
        """Close the nodes at and below a depth of the current path."""
        while len(self.stack) > down_to:
            node, name = self.stack.pop(), self.names.pop()
            above = self.stack[-1] if self.stack else None
            shard, k, p = self.place
            if node.bridge and node.ids:
                self.piece(node, name)
            if not node.bridge:
                node.leaves += not node.children and node.next is None
                node.saved += (node.n - 1) * node.size
            row = {
                "what": int(node.bridge), "shard": shard, "seq": None, "k": k, "depth": k * SEGMENT + len(self.stack),
                "node": name, "parent": self.names[-1] if above else None, "p": p, "next": node.next, "conv": node.conv, "parent_conv": None,
                "n": node.n, "size": node.size, "children": node.children, "leaves": node.leaves, "saved": node.saved,
                "ends": (node.ends or hashlib.sha256()).hexdigest(), "up": [*self.names, name] if node.bridge else None,
            }
            for child in node.waiting:
                child["parent_conv"] = node.conv
                self.out.append(child)
            if above is None:
                self.out.append(row)
                continue
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
            if not node.bridge:
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
            if node.bridge or above.bridge:
                self.out.append(row)  # the parent's smallest member is not known yet
            else:
                above.waiting.append(row)


def _shards(segs: DataFrame) -> DataFrame:
    """Closed nodes, partial skeleton nodes and pieces of their endings, by sorted shards."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = segs.sparkSession
    rows = segs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_ROWS))
    order = ["k", "p", "path", "c"]
    wanted = F.pmod(F.xxhash64("c", "k"), F.lit(max(rows, 1))) < parts * PER_SPLITTER
    # about PER_SPLITTER rows of at most SEGMENT digests per shard come to the driver
    sample = sorted((r["k"], r["p"], bytes(r["path"]), r["c"]) for r in segs.filter(wanted).select(*order).collect())
    step = -(-len(sample) // parts) or 1
    splitters = spark.sparkContext.broadcast(sample[step::step])

    def assign(batches):
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in order])
            shard = [bisect_right(splitters.value, key) for key in keys]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    schema = segs.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", shard int"
    dealt = segs.mapInArrow(assign, schema).repartition(parts, "shard").sortWithinPartitions("shard", *order)
    raw_schema = to_arrow_schema(spark.createDataFrame([], _RAW).schema)

    def finish(batches):
        walk = _Walk(splitters.value)
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "k", "p", "c", "path", "sizes", "next")]):
                walk.row(*row)
                if len(walk.out) >= 4096:
                    yield pa.RecordBatch.from_pylist(walk.out, raw_schema)
                    walk.out = []
        walk.close(0)
        yield pa.RecordBatch.from_pylist(walk.out, raw_schema)

    return materialise(dealt.mapInArrow(finish, _RAW))


def _endings(pieces: DataFrame) -> DataFrame:
    """(node, ends): the hash of each skeleton node's ids, streamed piece by piece; shards follow the order of ids."""
    import pyarrow as pa

    def stream(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pydict({"node": [x for x, _ in done], "ends": [x for _, x in done]}, out)
        if now is not None:
            yield pa.RecordBatch.from_pydict({"node": [now], "ends": [state.hexdigest()]}, out)

    out = pa.schema([("node", pa.string()), ("ends", pa.string())])
    rows = pieces.select("node", "shard", "seq", "ends").repartition("node").sortWithinPartitions("node", "shard", "seq")
    return rows.select("node", "ends").mapInArrow(stream, "node string, ends string")


def _skeleton(raw: DataFrame) -> DataFrame:
    """Skeleton nodes from their shards' parts: summed per node, then every node's own figures to all its ancestors."""
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("k", "depth", "parent", "p", "next", "size")]
    part = raw.filter("what = 1").groupBy("node").agg(F.min("conv").alias("conv"), F.first("up").alias("up"), *sums, *same)
    part = materialise(part)
    kids = part.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("inner"))
    part = part.join(kids, "node", "left").withColumn("children", F.col("children") + F.coalesce("inner", F.lit(0)))
    is_leaf = F.when((F.col("children") == 0) & F.col("next").isNull(), 1).otherwise(0)
    part = part.withColumn("leaves", F.col("leaves") + is_leaf).withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("size"))
    part = materialise(part)
    under = part.select(F.explode("up").alias("node"), "leaves", "saved").groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = part.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    out = part.drop("leaves", "saved").join(under, "node").join(parents, "parent", "left")
    out = out.join(_endings(raw.filter("what = 2")), "node", "left")
    return out.withColumn("ends", F.coalesce("ends", F.sha2(F.lit(b""), 256)))


def _below(segs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, more_leaves, more_saved): what later segments add to the nodes before them."""
    import pyarrow as pa

    later = segs.filter("k > 0").select("k", "p", "c")
    roots = nodes.filter(f"k > 0 AND depth = k * {SEGMENT}").select("k", "p", F.col("conv").alias("c"), "leaves", "saved")
    mine = later.join(roots, ["k", "p", "c"], "left").na.fill(0, ["leaves", "saved"])
    run = running_sums(mine, [F.col("k").desc()], ["leaves", "saved"], ["c"], totals=False)
    adds = run.filter("cum_leaves > 0 OR cum_saved > 0").select("c", (F.col("k") - 1).alias("k"), "cum_leaves", "cum_saved")
    paths = segs.filter("next IS NOT NULL").select("c", "k", "p", "path").join(adds, ["c", "k"])

    def spread(batches):
        for batch in batches:
            found = []
            for k, p, path, leaves, saved in zip(*[batch.column(c).to_pylist() for c in ("k", "p", "path", "cum_leaves", "cum_saved")]):
                found += [(_id(k, p, path[: 16 * d]), leaves, saved) for d in range(1 if k else 0, len(path) // 16 + 1)]
            names, a, b = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "a", "b"])

    wide = paths.select("k", "p", "path", F.col("cum_leaves").cast("long"), F.col("cum_saved").cast("long"))
    rows = wide.mapInArrow(spread, "node string, a long, b long")
    return rows.groupBy("node").agg(F.sum("a").alias("more_leaves"), F.sum("b").alias("more_saved"))


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node of the trie of (c, length) conversations and their (c, pos, key, size, length) turns: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    segs = segments(convs, turns)
    raw = _shards(segs)
    bridges = materialise(_skeleton(raw))
    parents = bridges.select(F.col("node").alias("parent"), F.col("conv").alias("bridge_conv"))
    closed = lookup_join(raw.filter("what = 0"), parents, ["parent"], "left", ["node"])
    closed = closed.withColumn("parent_conv", F.coalesce("parent_conv", "bridge_conv"))
    columns = ["k", "depth", "node", "p", "next", "conv", "parent_conv", "n", "children", "leaves", "saved", "ends"]
    nodes = materialise(closed.select(*columns).unionByName(bridges.select(*columns)))
    # a segment's root stands for the node that its conversations go on from
    roots = nodes.filter(f"k > 0 AND depth = k * {SEGMENT}").select(F.col("p").alias("next"), F.col("children").alias("onward"))
    gates = nodes.filter("next IS NOT NULL").select(F.col("next").alias("p"), F.col("conv").alias("gate_conv"))
    out = lookup_join(nodes.filter(f"k = 0 OR depth > k * {SEGMENT}"), _below(segs, nodes), ["node"], "left", ["node"])
    out = lookup_join(out, roots, ["next"], "left", ["node"])
    out = lookup_join(out, gates, ["p"], "left", ["node"])
    first = (F.col("k") > 0) & (F.col("depth") == F.col("k") * SEGMENT + 1)
    zero = F.lit(0)
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(first, F.col("gate_conv")).otherwise(F.col("parent_conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        (F.col("children") + F.coalesce("onward", zero)).alias("n_children"),
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, donor: Column, taken: Column, most: int) -> DataFrame:
    """Trie of the rebuilt conversations of a (conv_id, turn, role, text) table; see ``rebuild`` and ``trie``."""
    return trie(*rebuild(number_turns(conversations), donor, taken, most))
