"""Brute-force versions that the operators are held against."""

from __future__ import annotations

from collections import Counter, defaultdict
import math
import re

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def groups(n, pairs):
    """Smallest place reachable from each of n places."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_copies(rows, percent=75):
    """Sorted (doc_id, n_shingles, component_id) of (doc_id, text) rows with unique ids."""
    rows = sorted(rows)
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    pairs = []
    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < k)
        pairs += [(j, k) for j, n in common.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    found = groups(len(rows), pairs)
    return [(i, len(s), rows[found[k]][0]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def keep_lines(rows, min_chars=40, min_docs=5):
    """{doc_id: (n_lines, n_dropped, text)} of (doc_id, text) rows with unique ids."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)])]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def unigram(rows):
    """{doc_id: (n_tokens, n_known, N, base)} of (doc_id, text, training) rows."""
    tokens = {i: words(t) + [None] for i, t, _ in rows}
    count = Counter(x for i, _, train in rows if train for x in tokens[i])
    n, v = sum(count.values()), len(count)
    return {
        i: (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
        for i, w in tokens.items()
    }
