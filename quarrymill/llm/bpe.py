"""Byte-level BPE: encoding by monoid tree reduction, decoding by concatenation up the tree.

A piece (one match of the split pattern) is halved until it is short, the halves are encoded by themselves, and neighbours
are joined: the bytes of a window around the seam are encoded again and the window grows until the tokens on both sides of
it are settled. They are settled when each pair of neighbouring tokens at the window's ends encodes to itself: a sequence in
which all neighbours do so is the encoding of its bytes. Seams between pieces never merge, so there the product of the
monoid is plain concatenation, of ids when encoding and of bytes when decoding.

Rows are encoded where they lie, in Arrow batches; no shuffle. The rank table is read by the driver from the path given and
shipped once; its size is that of the vocabulary, whatever the data.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
import hashlib

from pyspark.sql import DataFrame, SparkSession

LEAF_BYTES = 24
#: Encodings of short pieces that a task remembers at most before it starts afresh.
MEMORY = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines of base64 bytes and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PieceEncoder:
    """Encodes byte strings by a rank table."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF_BYTES):
        self.ranks = ranks
        self.leaf = leaf
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.settled_pairs: dict[tuple[int, int], bool] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.table = None

    def greedy(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none merge."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 64:
            return self._greedy_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get, none = self.ranks.get, len(self.ranks) + 1_000_000
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _greedy_long(self, piece: bytes) -> list[int]:
        """The same with a heap of candidate merges, for windows that have grown long."""
        import heapq

        n, get = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # a live part starts at i and ends at end[i]
        before = list(range(-1, n - 1))
        live = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not live[i] or mid >= n or end[mid] != stop:
                continue  # one of its parts has been merged since
            live[mid] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        return [self.ranks[piece[i : end[i]]] for i in range(n) if live[i]]

    def _merge_table(self):
        """Sorted codes (left * 2^32 + right) of all pairs that merge, and the id each gives."""
        import numpy as np

        if self.table is None:
            codes, ids = [], []
            for token, i in self.ranks.items():
                for cut in range(1, len(token)):
                    a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                    if a is not None and b is not None:
                        codes.append(a << 32 | b)
                        ids.append(i)
            order = np.argsort(np.array(codes, "i8"))
            self.table = np.array(codes, "i8")[order], np.array(ids, "i8")[order]
        return self.table

    def greedy_batch(self, pieces: list[bytes]) -> list[bytes]:
        """``greedy`` for many short pieces side by side: each round merges the lowest pair of every unfinished piece.
        Ids come packed, little-endian, 4 bytes each."""
        import numpy as np

        codes, merged = self._merge_table()
        byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], "i8")
        never = np.int64(1) << 40
        out: list = [b""] * len(pieces)
        which = np.array([i for i, p in enumerate(pieces) if p], "i8")
        if not len(which):
            return out
        ids = byte_ids[np.frombuffer(b"".join(pieces), "u1")]
        owner = np.repeat(which, [len(pieces[i]) for i in which])

        def rank(at):
            """Of the pair that begins at each position."""
            nxt = np.minimum(at + 1, len(ids) - 1)
            want = ids[at] << 32 | ids[nxt]
            spot = np.minimum(np.searchsorted(codes, want), len(codes) - 1)
            good = (codes[spot] == want) & (owner[at] == owner[nxt]) & (nxt > at)
            return np.where(good, merged[spot], never)

        ranks = rank(np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            low = np.minimum.reduceat(ranks, first)
            done = low == never
            sizes = np.diff(np.r_[first, len(ids)])
            if done.any():
                packed = ids.astype("<u4").tobytes()
                for o, f, n in zip(owner[first[done]].tolist(), first[done].tolist(), sizes[done].tolist()):
                    out[o] = packed[4 * f : 4 * (f + n)]
                stay = np.repeat(~done, sizes)
                ids, owner, ranks = ids[stay], owner[stay], ranks[stay]
                low, sizes = low[~done], sizes[~done]
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == np.repeat(low, sizes))
            hit = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]  # the leftmost of each piece
            ids[hit] = ranks[hit]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            ids, owner, ranks = ids[stay], owner[stay], ranks[stay]
            hit = hit - np.arange(len(hit))
            ranks[hit] = rank(hit)
            left = hit[(hit > 0)] - 1
            ranks[left] = rank(left)
        return out

    def settled(self, a: int, b: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        known = self.settled_pairs.get((a, b))
        if known is None:
            if len(self.settled_pairs) > MEMORY:
                self.settled_pairs.clear()
            known = self.settled_pairs[a, b] = self.greedy(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings put together."""
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        take = 1
        while True:
            i, j = max(0, len(left) - take), min(len(right), take)
            window = self.greedy(b"".join(self.bytes_of[t] for t in left[i:] + right[:j]))
            if (i == 0 or self.settled(left[i - 1], window[0])) and (
                j == len(right) or self.settled(window[-1], right[j])
            ):
                return left[:i] + window + right[j:]
            take *= 2

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of a piece of any length; leaves seen lately are remembered."""
        if len(piece) <= self.leaf:
            known = self.leaves.get(piece)
            if known is None:
                if len(self.leaves) > MEMORY:
                    self.leaves.clear()
                known = self.leaves[piece] = self.greedy(piece)
            return known
        half = len(piece) // 2
        return self.join(self.encode(piece[:half]), self.encode(piece[half:]))


#: Code points below this are split by the standard library, which is several times faster.
NARROW = 0x250


def narrow_pattern(pattern: str, below: int = NARROW) -> str:
    """The pattern with its Unicode classes spelled out for code points below a bound; on texts of such code points it
    matches the same."""
    import unicodedata

    chars = [chr(i) for i in range(below)]
    spelled = {
        r"\p{L}": {c for c in chars if unicodedata.category(c)[0] == "L"},
        r"\p{N}": {c for c in chars if unicodedata.category(c)[0] == "N"},
        r"\s": {c for c in chars if c in "\t\n\x0b\x0c\r \x85\xa0"},
    }
    spelled[r"\S"] = set(chars) - spelled[r"\s"]

    def ranges(members) -> str:
        points, out = sorted(map(ord, members)), []
        for p in points:
            if out and out[-1][1] == p - 1:
                out[-1][1] = p
            else:
                out.append([p, p])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)

    out, i, inside = "", 0, False
    while i < len(pattern):
        name = next((n for n in spelled if pattern.startswith(n, i)), None)
        if name:
            body = ranges(spelled[name])
            out += body if inside else f"[{body}]"
            i += len(name)
            continue
        step = 2 if pattern[i] == "\\" else 1
        if step == 1:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
        out += pattern[i : i + step]
        i += step
    return out


class TextEncoder:
    """Encodes texts and remembers the packed ids of short pieces seen lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import numpy as np
        import regex

        self.pieces = PieceEncoder(ranks)
        self.known: dict[str, bytes] = {}
        self.split_any = regex.compile(pattern).findall
        self.split_narrow = re.compile(narrow_pattern(pattern)).findall
        self.wide = re.compile(f"[^\x00-\\u{NARROW - 1:04x}]").search
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for b, i in ranks.items():
            by_id[i] = b
        self.lengths = np.array([len(b) for b in by_id], "i8")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), "u1")

    def split(self, text: str) -> list[str]:
        return self.split_any(text) if self.wide(text) else self.split_narrow(text)

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode pieces not seen lately; the long ones, which are not remembered, come back."""
        import struct

        short, long = [], {}
        for p in pieces:
            raw = p.encode()
            if len(raw) <= LEAF_BYTES:
                short.append((p, raw))
            else:
                ids = self.pieces.encode(raw)
                long[p] = struct.pack(f"<{len(ids)}I", *ids)
        self.known.update(zip((p for p, _ in short), self.pieces.greedy_batch([raw for _, raw in short])))
        return long

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text: the product of its pieces' encodings."""
        split = [self.split(t) for t in texts]
        seen: set[str] = set()
        seen.update(*split)
        if len(self.known) > MEMORY:
            self.known = {}
        fresh = seen.difference(self.known)
        long = self._learn(fresh)
        table = self.known
        if long:
            table = {p: self.known[p] for p in seen if p not in long} | long
        get = table.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids; an id outside the table fails."""
        import numpy as np

        ids = np.frombuffer(packed, "<u4").astype("i8")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[at].tobytes()


def _chunks(texts, chars: int = 1_000_000):
    """Whole texts in lists of about so many characters."""
    held, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        held.append(t)
        size += len(t)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _shared(spark: SparkSession, ranks: dict[bytes, int]):
    return spark.sparkContext.broadcast(ranks)


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of every whole text. Null texts are empty; an empty text has no ids. Repeated rows are
    encoded each; an empty table gives an empty result."""
    import pyarrow as pa

    shared = _shared(docs.sparkSession, read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = TextEncoder(shared.value, pattern)
        for batch in batches:
            coded = (x for held in _chunks(batch.column(1)) for x in encoder.encode_many(held))
            ids = [np.frombuffer(x, "<u4").astype("i8") for x in coded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], names=["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(run, f"key {kind}, ids array<bigint>")
    return out.withColumnRenamed("key", key)


def decode_ids(rows: DataFrame, rank_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, data): the bytes of every row's ids. A null row gives no bytes; an id outside the table fails."""
    import pyarrow as pa

    shared = _shared(rows.sparkSession, read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {i: b for b, i in shared.value.items()}
        for batch in batches:
            data = [b"".join(map(bytes_of.__getitem__, row.as_py() or ())) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["key", "data"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, ids).mapInArrow(run, f"key {kind}, data binary").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes every whole text and decodes the ids again, keeping digests only.
    Nulls, empty texts and repeated rows as in ``encode_texts``."""
    import pyarrow as pa

    shared = _shared(docs.sparkSession, read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value, pattern)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for held in _chunks(batch.column(1)):
                for ids in encoder.encode_many(held):
                    counts.append(len(ids) // 4)
                    coded.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
