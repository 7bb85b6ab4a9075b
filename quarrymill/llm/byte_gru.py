"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by back-propagation through time on pieces of labelled texts. Its gates and candidates use the
softsign, x / (1 + |x|), a third of the cost of the hyperbolic tangent. Every byte of a text gets a distribution over the learned languages
from the states of both directions; a text's probabilities are the mean over all its bytes. Texts are read in windows of ``WINDOW``
bytes, each from a zero state on both sides, and no byte is left out; a task works on about a megabyte of whole texts at a time.

A null text or one without a letter is ``und`` with score 0, as is everything when there is nothing to learn from. Rows that
repeat are scored alike; rows with a null key are scored too. Columns not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .wordhash import buffers, slices

HIDDEN = 8
WINDOW = 128
#: Windows that a step advances together.
SIDE_BY_SIDE = 1024
#: Training sample, drawn by key hash: about this many texts of a language, of the so many commonest languages, and pieces of a text.
TEXTS_PER_LANGUAGE, MOST_LANGUAGES, PIECES = 400, 128, 4
STEPS, BATCH, RATE = 300, 192, 0.02


@dataclass
class Network:
    """Per direction: ``tables`` (3 H x 256: what a byte adds to update gate, reset gate and candidate), ``loops`` (3 H x H);
    ``heads`` (C x H per direction), ``bias`` (C)."""

    languages: list[str]
    tables: list[np.ndarray]
    loops: list[np.ndarray]
    heads: list[np.ndarray]
    bias: np.ndarray

    def parameters(self):
        return [*self.tables, *self.loops, *self.heads, self.bias]


def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda rows, cols, by: (rng.normal(size=(rows, cols)) * by).astype("f4")
    c = len(languages)
    tables = [draw(3 * hidden, 256, 0.4) for _ in range(2)]
    for table in tables:
        table[:hidden] += 1  # remember by default
    loops = [draw(3 * hidden, hidden, 0.4) for _ in range(2)]
    return Network(languages, tables, loops, [draw(c, hidden, 0.3) for _ in range(2)], np.zeros((c, 1), "f4"))


def _softsign(x: np.ndarray, room: np.ndarray) -> None:
    np.abs(x, out=room)
    room += 1
    x /= room


def run(table: np.ndarray, loop: np.ndarray, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States (T, H, B) over byte columns ``x`` (T, B); a state is zero where ``mask`` is. ``keep`` collects what the
    backward pass needs."""
    steps, wide = x.shape
    hidden = loop.shape[1]
    out = np.empty((steps, hidden, wide), "f4")
    h = np.zeros((hidden, wide), "f4")
    given, own, room = (np.empty((3 * hidden, wide), "f4") for _ in range(3))
    for t in range(steps):
        np.take(table, x[t], axis=1, out=given, mode="clip")
        np.matmul(loop, h, out=own)
        gates = own[: 2 * hidden]
        gates += given[: 2 * hidden]
        _softsign(gates, room[: 2 * hidden])
        gates += 1
        gates *= np.float32(0.5)
        z, r, n = own[:hidden], own[hidden : 2 * hidden], own[2 * hidden :]
        back = n.copy() if keep is not None else None
        n *= r
        n += given[2 * hidden :]
        _softsign(n, room[2 * hidden :])
        if keep is not None:
            keep.append((z.copy(), r.copy(), n.copy(), back, h.copy()))
        h = out[t]
        np.subtract(out[t - 1] if t else 0, n, out=h)
        h *= z
        h += n
        if mask is not None:
            h *= mask[t]
    return out


def _directions(net: Network, x: np.ndarray, mask: np.ndarray | None, keeps=(None, None)) -> list[np.ndarray]:
    """States of both directions, by position."""
    ahead = run(net.tables[0], net.loops[0], x, mask, keeps[0])
    behind = run(net.tables[1], net.loops[1], x[::-1], None if mask is None else mask[::-1], keeps[1])
    return [ahead, behind[::-1]]


def position_probabilities(net: Network, x: np.ndarray, mask: np.ndarray | None = None, states=None) -> np.ndarray:
    """(T, C, B): the distribution over languages at every position."""
    ahead, behind = states or _directions(net, x, mask)
    score = np.matmul(net.heads[0], ahead)
    score += np.matmul(net.heads[1], behind)
    score += net.bias
    np.clip(score, -40, 40, out=score)
    np.exp(score, out=score)
    score /= score.sum(axis=1, keepdims=True)
    return score


def _back(table, loop, x, mask, keep, dout):
    """Gradients of ``table`` and ``loop`` from those of the states, in the order of ``run``."""
    hidden = loop.shape[1]
    into = np.empty((len(x), 3 * hidden, x.shape[1]), "f4")
    dloop, dh = np.zeros_like(loop), np.zeros_like(dout[0])
    for t in range(len(x) - 1, -1, -1):
        z, r, n, back, before = keep[t]
        dh = dh + dout[t]
        if mask is not None:
            dh = dh * mask[t]
        dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
        own = np.concatenate([dh * (before - n), dn * back, dn * r])
        gates = own[: 2 * hidden]
        gates *= 0.5 * (1 - np.abs(2 * np.concatenate([z, r]) - 1)) ** 2
        into[t, : 2 * hidden], into[t, 2 * hidden :] = gates, dn
        dloop += own @ before.T
        dh = dh * z + loop.T @ own
    flat, at = into.transpose(1, 0, 2).reshape(3 * hidden, -1), x.ravel()
    dtable = np.stack([np.bincount(at, row, 256) for row in flat]).astype("f4")
    return dtable, dloop


def gradients(net: Network, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions and its gradients, for byte columns ``x`` (T, B) of texts in languages ``y``."""
    keeps: tuple[list, list] = ([], [])
    states = _directions(net, x, mask, keeps)
    p = position_probabilities(net, x, mask, states)
    total = mask.sum()
    columns = np.arange(x.shape[1])
    loss = float(-(np.log(np.maximum(p[:, y, columns], 1e-30)) * mask).sum() / total)
    p[:, y, columns] -= 1
    p *= mask[:, None, :] / total
    dheads = [np.einsum("tcb,thb->ch", p, s, optimize=True) for s in states]
    dstates = [np.matmul(head.T, p) for head in net.heads]
    a = _back(net.tables[0], net.loops[0], x, mask, keeps[0], dstates[0])
    b = _back(net.tables[1], net.loops[1], x[::-1], mask[::-1], keeps[1], dstates[1][::-1])
    return loss, [a[0], b[0], a[1], b[1], *dheads, p.sum(axis=(0, 2))[:, None]]


def _columns(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, texts))
    x = np.zeros((len(texts), longest), "u1")
    for row, text in zip(x, texts):
        row[: len(text)] = np.frombuffer(text, "u1")
    mask = np.arange(longest)[:, None] < np.array([len(t) for t in texts])[None, :]
    return np.ascontiguousarray(x.T), mask.astype("f4")


def train(pieces: list[tuple[str, bytes]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> Network:
    """Fit on (language, bytes) pieces, the languages equally often; a quarter of the pieces is cut short, for short texts."""
    languages = sorted({lang for lang, _ in pieces})
    net = fresh(languages)
    groups = [[text for lang, text in pieces if lang == name] for name in languages]
    rng = np.random.default_rng(seed)
    parameters = net.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1 if len(languages) > 1 else 1):
        y = rng.integers(len(languages), size=batch)
        texts = [groups[k][rng.integers(len(groups[k]))] for k in y]
        texts = [t[: rng.integers(1, 25)] if cut else t for t, cut in zip(texts, rng.random(batch) < 0.25)]
        _, grads = gradients(net, *_columns(texts), y)
        length = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, 3 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for p, g, m, v in zip(parameters, grads, first, second):
            g = g * min(1.0, 1.0 / (length + 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (pace * m / (np.sqrt(v) + 1e-6)).astype("f4")
    return net


def pool(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, C): mean distribution over all bytes of each text; zero for empty texts."""
    lengths = np.diff(offsets)
    per = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), per)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = offsets[:-1][owner] + place * WINDOW
    size = np.minimum(WINDOW, lengths[owner] - place * WINDOW)
    order = np.argsort(-size, kind="stable")
    total = np.zeros((len(lengths), len(net.languages)))
    for i in range(0, len(order), SIDE_BY_SIDE):
        mine = order[i : i + SIDE_BY_SIDE]
        sizes = size[mine]
        at = np.arange(sizes[0])[:, None]
        inside = at < sizes[None, :]
        x = data[np.minimum(begin[mine][None, :] + at, len(data) - 1)]
        mask = None if sizes[-1] == sizes[0] else inside.astype("f4")
        p = position_probabilities(net, x, mask)
        if mask is not None:
            p *= mask[:, None, :]
        sums = p.sum(axis=0)
        for c in range(len(net.languages)):
            total[:, c] += np.bincount(owner[mine], sums[c], len(lengths))
    return total / np.maximum(lengths, 1)[:, None]


def sample_pieces(rows: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, bytes]]:
    """(language, bytes) pieces of at most ``WINDOW`` bytes: ``PIECES`` places of about ``TEXTS_PER_LANGUAGE`` texts of each of the
    ``MOST_LANGUAGES`` commonest languages (bounds of the training sample), chosen by key hash."""
    known = rows.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    known = known.filter(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    counts = known.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES)
    span = F.char_length("t") - WINDOW
    piece = lambda j: F.substring(F.col("t"), (F.floor(F.greatest(span, F.lit(0)) * j / (PIECES - 1)) + 1).cast("int"), F.lit(WINDOW))
    part = F.pmod(F.xxhash64("k", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = known.join(F.broadcast(counts), "l").filter(part * F.col("n") < TEXTS_PER_LANGUAGE)
    drawn = drawn.select("l", F.explode(F.array_distinct(F.array(*[piece(j) for j in range(PIECES)]))).alias("t"))
    return sorted((r["l"], r["t"].encode()[:WINDOW]) for r in drawn.collect() if r["t"])


def fit(rows: DataFrame, key: str, text: str, lang: str) -> Network | None:
    """The network of the labelled rows, or None where no row has a label and a letter."""
    pieces = sample_pieces(rows, key, text, lang)
    return train(pieces) if pieces else None


def identify(docs: DataFrame, key: str, text: str, net: Network | None) -> DataFrame:
    """(key, lang_pred, score, probabilities) of every row; ``probabilities`` in the order of ``net.languages``, null for ``und``."""
    import pyarrow as pa

    rows = docs.select(F.col(key), F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("__text"))
    key_type = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, lang_pred string, score double, probabilities array<double>"
    if net is None:
        none = F.lit(None).cast("array<double>")
        return rows.select(key, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("probabilities"))

    def label(batches):
        names = np.array([*net.languages, "und"], object)
        for batch in batches:
            column = batch.column(1)
            data, offsets = buffers(column)
            missing = column.is_null().to_numpy(zero_copy_only=False)
            for a, b in slices(offsets):
                inner = offsets[a : b + 1]
                p = pool(net, data[inner[0] : inner[-1]], inner - inner[0])
                best = np.where(missing[a:b], len(net.languages), p.argmax(axis=1))
                score = np.where(missing[a:b], 0.0, np.minimum(p.max(axis=1), 1.0))
                shares = [None if gone else row for row, gone in zip(p.tolist(), missing[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(names[best], pa.string()), pa.array(score), pa.array(shares, pa.list_(pa.float64()))],
                    [key, "lang_pred", "score", "probabilities"],
                )

    return rows.mapInArrow(label, schema)


def identify_languages(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Languages of all rows, learned from those where ``learn`` holds; see ``identify``."""
    return identify(docs, key, text, fit(docs.filter(learn), key, text, lang))
