"""Exact set-similarity join of texts on word shingles, by parity sketches.

The shingles of a text are 64-bit hashes. A parity sketch XORs set members into places chosen by hash: members common to two
sets cancel, so two sketches differ in at most as many places as the symmetric difference has members. Two sets with
100 * |A n B| >= percent * |A u B| have |A ^ B| <= (100 - percent)(|A| + |B|) / (100 + percent).

1. ``_describe``: per text its set size, a fingerprint of the set and a bit sketch (two to four bits a shingle). Equal
   fingerprints are one node from here on, so groups of exact copies never meet in a join.
2. ``_signatures``: pigeonhole join. A size band deals a set's members into k parts and XORs the hashes of each part. If more
   parts of a set are occupied than members may differ, a partner equals it in one occupied part at least. Members that very
   many texts share (``_common``) are left out first, which only lowers the difference; a set too poor without them
   adds the parts of all its members, and, if still too poor, its empty parts. So no pair is lost, while passages that a
   third of all texts hold do not gather those texts. The signatures travel as packed arrays, one bucket of hashes per task.
3. Candidate pairs are screened by set sizes and by the Hamming distance of the bit sketches (folded to equal length), then
   verified on the shingles of the texts.
4. Signatures shared by many nodes make groups, named by their smallest node. A group first gives a star around the member
   that stands in most such signatures of all buckets, so the groups of one cluster have one centre (``_stars``). After the
   stars' links are joined into components, each node of such a group is compared with its nearest by sketch in another component, until no more
   links are found this way; then all pairs of the group that still lie in different components are screened (in blocks of
   bounded size) and verified. So large groups of near copies cost comparisons in proportion to their size.

Only candidate texts are read a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..plans.session import materialise, settle
from ..plans.skew import lookup_join, salted_join
from .components import components
from .exprs import only_ids
from .wordhash import buffers, mix, shingle_sets, slices

SMALL_GROUP = 16
BLOCK = 1024
SIGNATURES_A_BUCKET = 1_500_000
SHINGLES_A_PACK = 400_000
_SALT = np.array([0x5851F42D4C957F2D, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], "u8")


def differ(a: int, b: int, percent: int) -> int:
    """Members that two sets of these sizes may have apart."""
    return (100 - percent) * (a + b) // (100 + percent)


def parts(n: np.ndarray, percent: int) -> np.ndarray:
    """Parts of the band that a set size belongs to, a power of two: enough of them are occupied even so."""
    n = np.maximum(np.asarray(n, "i8"), 1)
    least = n * (1.22 * 2 * (100 - percent) / (100 + percent)) + 4
    return 1 << np.ceil(np.log2(least)).astype("i8")


def sketch_bits(n: np.ndarray) -> np.ndarray:
    return 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * np.asarray(n, "i8"), 1))).astype("i8"))


def fingerprints(s: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """One 63-bit number per set, equal for equal sets."""
    total = np.zeros(n, "u8")
    np.add.at(total, row, mix(s ^ np.uint64(0x2545F4914F6CDD1D)))
    size = np.bincount(row, minlength=n).astype("u8")
    return (mix(total ^ (size * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(1)).astype("i8")


def bit_sketches(s: np.ndarray, row: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    bits = sketch_bits(sizes)
    base = np.cumsum(bits) - bits
    at = base[row] + (s & (bits[row] - 1).astype("u8")).astype("i8")
    flat = np.zeros(int(bits.sum()), "u1")
    np.bitwise_xor.at(flat, at, np.uint8(1))
    packed = np.packbits(flat, bitorder="little").tobytes()
    return [packed[b // 8 : (b + k) // 8] for b, k in zip(base.tolist(), bits.tolist())]


def hamming(a: bytes, b: bytes) -> int:
    """Of two sketches, the longer folded to the shorter one's length."""
    if len(a) < len(b):
        a, b = b, a
    x, size = int.from_bytes(a, "little"), len(a)
    while size > len(b):
        size //= 2
        x = (x & ((1 << 8 * size) - 1)) ^ (x >> 8 * size)
    return (x ^ int.from_bytes(b, "little")).bit_count()


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """Rows of two kinds: (doc_id, n, fp, sketch) for a text; (token, cnt) for a shingle frequent within an Arrow batch."""
    import pyarrow as pa

    names = ["doc_id", "n", "fp", "sketch", "token", "cnt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            held = []
            for first, last in slices(offsets):
                o = offsets[first : last + 1]
                s, row = shingle_sets(data[o[0] : o[-1]], o - o[0], size)
                n = np.bincount(row, minlength=last - first)
                held.append(s)
                k = last - first
                empty = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, k), pa.array(n, pa.int64()), pa.array(fingerprints(s, row, k)),
                    pa.array(bit_sketches(s, row, n), pa.binary()), empty, empty,
                ], names=names)
            if held:
                s, counts = np.unique(np.concatenate(held), return_counts=True)
                often = counts >= 4
                k = int(often.sum())
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    none, none, none, pa.nulls(k, pa.binary()), pa.array(s[often].view("i8")),
                    pa.array(counts[often].astype("i8")),
                ], names=names)

    kinds = "doc_id long, n long, fp long, sketch binary, token long, cnt long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def _common(described: DataFrame, total: int, most: int = 1_000_000) -> np.ndarray:
    """Shingles held by more than total / most texts (and 20): at most ``most`` of them, 8 bytes each. The counts are
    lower bounds, since shingles rare within a batch are not reported; any choice of shingles leaves the join exact."""
    floor = max(20, -(-total // most))
    found = described.filter("token IS NOT NULL").groupBy("token").agg(F.sum("cnt").alias("c")).filter(F.col("c") > floor)
    rows = found.select("token").toPandas()["token"].to_numpy("i8")
    return np.sort(rows.view("u8"))


def _keys(s, row, sizes, common, percent):
    """(key, row) of all signatures of a run of texts."""
    n = len(sizes)
    if len(common):
        spot = np.minimum(np.searchsorted(common, s), len(common) - 1)
        cold = common[spot] != s
    else:
        cold = np.ones(len(s), bool)
    own, next_ = parts(sizes, percent), parts(sizes * 100 // percent, percent)
    # the largest set of each band, to bound a partner's size
    bands = np.unique(np.r_[own, next_])
    top = {}
    for k in bands.tolist():
        low, high = 1, 2 * int(k) * (100 + percent) // (100 - percent) + 8
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if int(parts(np.array([mid]), percent)[0]) <= k else (low, mid - 1)
        top[k] = low
    out_keys, out_rows = [], []
    for level in (own, next_):
        active = (sizes > 0) if level is own else (sizes > 0) & (next_ != own)
        if not active.any():
            continue
        k = np.where(active, level, 0)
        base = np.cumsum(k) - k
        total = int(k.sum())
        owner = np.repeat(np.arange(n), k)
        part = np.arange(total) - base[owner]
        partner = np.minimum(sizes * 100 // percent, np.array([top.get(int(x), 0) for x in level]))
        need = (100 - percent) * (sizes + partner) // (100 + percent) + 1

        def deal(members):
            at = base[row[members]] + (s[members] >> np.uint64(20) & (k[row[members]] - 1).astype("u8")).astype("i8")
            acc = np.zeros(total, "u8")
            np.bitwise_xor.at(acc, at, s[members])
            full = np.zeros(total, bool)
            full[at] = True
            return acc, full

        def put(acc, chosen, salt):
            place = mix((part[chosen].astype("u8") << np.uint64(34)) ^ k[owner[chosen]].astype("u8") ^ _SALT[salt])
            out_keys.append(mix(acc[chosen] ^ place))
            out_rows.append(owner[chosen])

        members = np.flatnonzero(cold & active[row])
        acc, full = deal(members)
        put(acc, np.flatnonzero(full), 0)
        poor = active & (np.bincount(owner[full], minlength=n) < need)
        if poor.any():
            members = np.flatnonzero(poor[row])
            acc, full = deal(members)
            put(acc, np.flatnonzero(full), 1)
            poorer = poor & (np.bincount(owner[full], minlength=n) < need)
            put(acc, np.flatnonzero(poorer[owner] & ~full), 2)
    if not out_keys:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    return np.concatenate(out_keys), np.concatenate(out_rows)


def _signatures(docs: DataFrame, shared, buckets: int, size: int, percent: int) -> DataFrame:
    """Packed signatures, without the shingles of the broadcast ``shared``: (bucket, keys as 4-byte numbers, 2-byte places in fps, fps). Within a bucket of bounded size the
    short keys coincide by chance for a few pairs only, which the screen takes out."""
    import pyarrow as pa

    flush_at = 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            keys, rows, fps, held, base = [], [], [], 0, 0

            def flush():
                if not keys:
                    return None
                k, r, f = np.concatenate(keys), np.concatenate(rows), np.concatenate(fps)
                to = (k >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(to.astype("u2" if buckets < 65536 else "i8"), kind="stable")
                to, k, r = to[order], (k[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), r[order].astype("<u2")
                at = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, "i8")
                ends = np.r_[at[1:], len(to)]
                # a bucket gets the fingerprints that its own keys name, so that rows grow with keys, not with buckets
                named = [np.unique(r[i:j], return_inverse=True) for i, j in zip(at, ends)]
                return pa.RecordBatch.from_arrays([
                    pa.array(to[at].astype("i4"), pa.int32()),
                    pa.array([k[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
                    pa.array([place.astype("<u2").tobytes() for _, place in named], pa.binary()),
                    pa.array([f[own].astype("<i8").tobytes() for own, _ in named], pa.binary()),
                ], names=["bucket", "keys", "places", "fps"])

            seen: set[int] = set()
            for first, last in slices(offsets, most=20_000):
                o = offsets[first : last + 1]
                s, row = shingle_sets(data[o[0] : o[-1]], o - o[0], size)
                n = last - first
                sizes = np.bincount(row, minlength=n)
                fp = fingerprints(s, row, n)
                new = np.zeros(n, bool)
                for i, x in enumerate(fp.tolist()):  # one of the equal sets of a batch is enough
                    if x not in seen:
                        seen.add(x)
                        new[i] = True
                s, row = s[new[row]], row[new[row]]
                sizes = np.where(new, sizes, 0)
                k, r = _keys(s, row, sizes, common, percent)
                if held and (held + len(k) > flush_at or base + n > 60_000):
                    yield flush()
                    keys, rows, fps, held, base = [], [], [], 0, 0
                keys.append(k)
                rows.append(r + base)
                fps.append(fp)
                held += len(k)
                base += n
            out = flush()
            if out is not None:
                yield out

    return docs.select("text").mapInArrow(run, "bucket int, keys binary, places binary, fps binary")


def _unique_pairs(a, b):
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _meet(rows):
    """Of one bucket: kind 0, a pair of nodes; kind 1, (group, node) of signatures that more than a few nodes share, and how
    many of them."""
    import pandas as pd

    keys, nodes = [], []
    for k, p, f in zip(rows["keys"], rows["places"], rows["fps"]):
        keys.append(np.frombuffer(k, "<u4"))
        nodes.append(np.frombuffer(f, "<i8")[np.frombuffer(p, "<u2")])
    key, node = np.concatenate(keys), np.concatenate(nodes)
    order = np.argsort(key)
    key, node = key[order], node[order]
    same = key[1:] == key[:-1]
    keep = np.r_[False, same] | np.r_[same, False]
    node, key = _unique_pairs(node[keep], key[keep].astype("i8"))
    order = np.argsort(key, kind="stable")  # by key, then node
    key, node = key[order], node[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, "i8")
    counts = np.diff(np.r_[first, len(key)])
    pair_a, pair_b = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
    size = np.repeat(counts, counts)
    few, many = size <= SMALL_GROUP, size > SMALL_GROUP
    fk, fn = key[few], node[few]
    for step in range(1, SMALL_GROUP):
        hit = fk[step:] == fk[:-step] if len(fk) > step else np.zeros(0, bool)
        if not hit.any():
            break
        pair_a.append(fn[:-step][hit])
        pair_b.append(fn[step:][hit])
    a, b = _unique_pairs(np.concatenate(pair_a), np.concatenate(pair_b))
    # groups are named by their smallest node: those of one cluster share it mostly, and are one group then
    group, member = np.repeat(node[first], counts)[many], node[many]
    order = np.lexsort((member, group))
    group, member = group[order], member[order]
    at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (member[1:] != member[:-1])]) if len(group) else np.zeros(0, "i8")
    times = np.diff(np.r_[at, len(group)])
    return pd.DataFrame({
        "kind": np.r_[np.zeros(len(a), "i4"), np.ones(len(at), "i4")],
        "a": np.r_[a, group[at]],
        "b": np.r_[b, member[at]],
        "times": np.r_[np.zeros(len(a), "i8"), times],
    })


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of every member (g, fp, times) of a group with the group's centre: the member that stands in most
    signatures over all groups. Of near copies of one text, that text shares most signatures with the others."""
    popular = members.groupBy("fp").agg(F.sum("times").alias("popular"))
    centres = members.join(popular, "fp").groupBy("g").agg(F.max_by("fp", F.struct("popular", "fp")).alias("centre"))
    pairs = lookup_join(members.select("g", "fp"), centres, ["g"], "inner", salt_on=["fp"]).filter("centre <> fp")
    return pairs.select(F.least("centre", "fp").alias("a"), F.greatest("centre", "fp").alias("b"))


def _screen(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and sketches allow a link, with their sizes."""
    import pyarrow as pa

    ends = lambda x: nodes.select(F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    # the centre of a star has as many pairs as its group has members: such keys are salted
    pairs = settle(pairs)
    both = salted_join(pairs, ends("a"), ["a"], "inner", salt_on=["b"]).filter("na > 0")
    counts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    both = salted_join(both, ends("b"), ["b"], "inner", salt_on=["a"], counts=counts)
    both = both.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "na", "nb", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 6)]
            good = [hamming(x, y) <= differ(n, m, percent) for n, m, x, y in zip(*cols)]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long, na long, nb long")


def _verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) among screened pairs, by the shingles of one text of each node. Pairs are packed by their first node; a
    node with many partners is spread over packs. The texts travel once per pack."""
    import pandas as pd

    pairs = materialise(pairs)
    volume = pairs.agg(F.coalesce(F.sum(F.col("na") + F.col("nb")), F.lit(0))).first()[0]
    if not volume:
        return pairs.select("a", "b")
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = max(shuffles, int(volume // SHINGLES_A_PACK) + 1)
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("deg"))
    # partners of one node in runs of about 64
    spread = lookup_join(pairs, degree, ["a"], "inner", salt_on=["b"]).withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("deg") / 64)))
    spread = materialise(spread.withColumn("pack", F.pmod(F.xxhash64("a", "part"), F.lit(packs))).select("pack", "a", "b"))
    ends = spread.select("pack", F.col("a").alias("fp")).unionByName(spread.select("pack", F.col("b").alias("fp"))).distinct()
    wanted = materialise(ends.join(nodes.select("fp", "doc_id"), "fp").select("pack", "fp", "doc_id"))
    texts = only_ids(docs.select(F.col("doc_id").cast("long"), "text"), wanted, "doc_id")
    texts = texts.join(wanted.select("pack", "doc_id"), "doc_id").select("pack", "text")

    def check(left, right):
        import pyarrow as pa

        if not len(left):
            return pd.DataFrame({"a": [], "b": []}, dtype="i8")
        sets = {}
        data, offsets = buffers(pa.array(right["text"], pa.large_string()))
        for first, last in slices(offsets):
            o = offsets[first : last + 1]
            s, row = shingle_sets(data[o[0] : o[-1]], o - o[0], size)
            bounds = np.searchsorted(row, np.arange(last - first + 1))
            for i, fp in enumerate(fingerprints(s, row, last - first).tolist()):
                sets[fp] = s[bounds[i] : bounds[i + 1]]
        good = []
        for a, b in zip(left["a"].tolist(), left["b"].tolist()):
            x, y = sets[a], sets[b]
            if len(x) > len(y):
                x, y = y, x
            spot = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[spot] == x).sum())
            good.append(100 * both >= percent * (len(x) + len(y) - both))
        good = np.array(good, bool)
        return pd.DataFrame({"a": left["a"].to_numpy()[good], "b": left["b"].to_numpy()[good]})

    return spread.groupBy("pack").cogroup(texts.groupBy("pack")).applyInPandas(check, "a long, b long")


def _open_pairs(members: DataFrame, links: DataFrame, nodes: DataFrame, percent: int, nearest: bool):
    """Pairs of large groups whose ends lie in different components of the links found so far and which sizes and sketches
    allow; with ``nearest``, only each node's pair of least distance in a block. Groups are compared in blocks of bounded
    size. Returns the pairs and the nodes that have any (components only grow, so the others need no further look); None
    where no group has two components."""
    import pandas as pd

    comp = components(links).withColumnsRenamed({"node": "fp", "component": "comp"})
    rows = members.join(comp, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    groups = groups.filter("x <> y").select("g", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = materialise(rows.join(groups, "g"))
    if rows.isEmpty():
        return None
    rows = rows.join(nodes.select("fp", "n", "sketch"), "fp").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("i", "j"), "hi": F.greatest("i", "j")})
    # small groups share a task's call: one Python group for many of them
    rows = rows.withColumn("call", F.when(F.col("blocks") > 1, F.xxhash64("g", "lo", "hi")).otherwise(F.pmod(F.xxhash64("g"), F.lit(2000))))

    def screen(part):
        from collections import defaultdict

        found_a, found_b, alive = [np.zeros(0, "i8")], [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        for _, grp in part.groupby(["g", "lo", "hi"]):
            n, fp, comp = grp["n"].to_numpy("i8"), grp["fp"].to_numpy("i8"), grp["comp"].to_numpy("i8")
            block = grp["i"].to_numpy("i8")
            cross = int(grp["lo"].iloc[0]) != int(grp["hi"].iloc[0])
            by_size = defaultdict(list)
            for x, sk in enumerate(grp["sketch"]):
                by_size[len(sk)].append(x)
            bits = {}
            for z, at in by_size.items():
                bits[z] = (np.array(at), np.frombuffer(b"".join(grp["sketch"].iloc[x] for x in at), "u8").reshape(len(at), -1))
            for za, (ia, sa) in bits.items():
                for zb, (ib, sb) in bits.items():
                    if za < zb or za > 4 * zb:
                        continue
                    left = sa
                    while left.shape[1] > sb.shape[1]:
                        half = left.shape[1] // 2
                        left = left[:, :half] ^ left[:, half:]
                    for k in range(len(ia)):
                        x = ia[k]
                        near = (np.minimum(n[x], n[ib]) * 100 >= np.maximum(n[x], n[ib]) * percent) & (comp[ib] != comp[x])
                        if cross:
                            near &= block[ib] != block[x]
                        if za == zb:
                            near &= ib > x
                        c = np.flatnonzero(near)
                        if not len(c):
                            continue
                        far = np.bitwise_count(sb[c] ^ left[k]).sum(1, dtype="i8")
                        good = far <= (100 - percent) * (n[x] + n[ib[c]]) // (100 + percent)
                        if not good.any():
                            continue
                        alive += [fp[x : x + 1], fp[ib[c[good]]]]
                        if nearest:
                            good = np.arange(len(c)) == np.argmin(np.where(good, far / (n[x] + n[ib[c]]), np.inf))
                        c = ib[c[good]]
                        found_a.append(np.minimum(fp[x], fp[c]))
                        found_b.append(np.maximum(fp[x], fp[c]))
        a, b = _unique_pairs(np.concatenate(found_a), np.concatenate(found_b))
        own = np.unique(np.concatenate(alive))
        return pd.DataFrame({"kind": np.r_[np.zeros(len(a), "i4"), np.ones(len(own), "i4")], "a": np.r_[a, own], "b": np.r_[b, own]})

    found = rows.select("call", "g", "lo", "hi", "i", "fp", "comp", "n", "sketch").groupBy("call").applyInPandas(screen, "kind int, a long, b long")
    found = materialise(found)
    pairs = found.filter("kind = 0").select("a", "b").distinct()
    alive = found.filter("kind = 1").select(F.col("a").alias("fp")).distinct()
    sizes = nodes.select("fp", "n")
    pairs = pairs.join(sizes.withColumnsRenamed({"fp": "a", "n": "na"}), "a").join(sizes.withColumnsRenamed({"fp": "b", "n": "nb"}), "b")
    return pairs.select("a", "b", "na", "nb"), alive


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (columns ``doc_id`` and ``text``).

    Words are runs of characters outside ASCII white space, A-Z lower-cased; a set holds a text's distinct shingles of
    ``size`` words, or the whole word sequence where there are fewer. Two rows link when
    100 * |A n B| >= ``percent`` * |A u B|; ``component_id`` is the smallest ``doc_id`` reachable by links, itself included.

    Null texts and texts without words have an empty set and link with nothing. Equal sets always link; repeated rows each
    come back. A row without a ``doc_id`` comes back with the smallest id of the rows it links with, or null. An empty table
    gives an empty result. Further columns are ignored. Sets are compared by 64-bit hashes: two different shingles or sets
    count as one with a probability of about 2^-64 a pair.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = materialise(_describe(docs, size))
    texts = described.filter("token IS NULL").select("doc_id", "n", "fp", "sketch")
    nodes = texts.filter("n > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    sketches = texts.select("doc_id", "fp", "sketch").withColumnRenamed("doc_id", "__id")
    one = nodes.join(sketches, (nodes["fp"] == sketches["fp"]) & (nodes["doc_id"] == sketches["__id"])).select(
        nodes["fp"], nodes["doc_id"], "n", "sketch"
    )
    nodes = materialise(one.dropDuplicates(["fp"]))
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total:
        every = texts.agg(F.sum("n")).first()[0]  # copies are counted, so the bound on common shingles counts them too
        common = docs.sparkSession.sparkContext.broadcast(_common(described, int(every)))
        shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(shuffles, int(total * 0.7 // SIGNATURES_A_BUCKET) + 1)
        packed = _signatures(docs.filter("doc_id IS NOT NULL"), common, buckets, size, percent)
        met = materialise(packed.groupBy("bucket").applyInPandas(_meet, "kind int, a long, b long, times long"))
        common.destroy()
        members = met.filter("kind = 1").groupBy(F.col("a").alias("g"), F.col("b").alias("fp")).agg(F.sum("times").alias("times"))
        members = materialise(members)
        pairs = met.filter("kind = 0").select("a", "b").unionByName(_stars(members)).distinct()
        links = materialise(_verify(_screen(pairs, nodes, percent), nodes, docs, size, percent))
        members = members.select("g", "fp")
        for nearest in (True, False):
            open_ = _open_pairs(members, links, nodes, percent, nearest)
            if open_ is None:
                break
            more, alive = open_
            members = materialise(members.join(alive, "fp", "left_semi"))
            found = materialise(_verify(more, nodes, docs, size, percent))
            links = links.unionByName(found)
        comp = components(links).withColumnsRenamed({"node": "fp", "component": "comp"})
    else:
        comp = nodes.select("fp", F.col("fp").alias("comp"))
    placed = nodes.select("fp", "doc_id").join(comp, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    smallest = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    placed = materialise(placed.join(smallest, "comp").select("fp", "component_id"))
    out = texts.select("doc_id", F.col("n").alias("n_shingles"), "fp").withColumn("set", F.when(F.col("n_shingles") > 0, F.col("fp")))
    # copies of one set may be a third of all rows: the sets that many rows share are few and looked up by broadcast
    rows = texts.filter("n > 0").groupBy("fp").agg(F.count(F.lit(1)).alias("c"))
    floor = max(1000, texts.count() // 1000)
    hot = placed.join(rows.filter(F.col("c") >= floor).select("fp"), "fp").select(F.col("fp").alias("set"), F.col("component_id").alias("hot"))
    out = out.join(F.broadcast(hot), "set", "left")
    out = out.withColumn("set", F.when(F.col("hot").isNull(), F.col("set")))
    out = out.join(placed.withColumnRenamed("fp", "set"), "set", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("hot", "component_id", "doc_id").alias("component_id"))
