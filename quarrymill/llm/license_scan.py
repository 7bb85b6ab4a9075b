"""Licence scan over a positional index of rare template words.

The index lists, for every licence word that few templates hold, the templates and positions where it stands. Each text's
licence words with the highest inverse template frequency are looked up; postings of one template that agree on the offset
(position in the text minus position in the template) are counted; a template with enough agreeing words is reported once
its mandatory phrase is found word by word at that offset. Phrases that name a licence by themselves are found at any place.

Only DataFrame functions are used: no Python runs on the executors. The index is built from the fixed texts below, so its
size does not depend on the data.
"""

from __future__ import annotations

from collections import Counter
import math

from pyspark.sql import Column, DataFrame, functions as F

from .exprs import let, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that give a label wherever they stand.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, opening words of the public licence text or notice, and the phrase in it that must be there.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "permission is hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the software", "this permission notice shall be included"),
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "source and binary forms"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
     "by the free software foundation", "lesser general public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice", "distribute this software"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this "
     "work", "waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
]
#: Agreeing rare words that make a template a candidate; one is enough where its mandatory phrase has only one rare word.
MIN_AGREEING = 2
#: A word is rare when at most this many templates hold it.
MAX_TEMPLATES = 2


def rare_postings(templates=TEMPLATES, most: int = MAX_TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """word -> [(template, position)] for words of high inverse template frequency, each at its first position."""
    first = [{} for _ in templates]
    for t, (_, text, _) in enumerate(templates):
        for i, w in enumerate(text.split()):
            first[t].setdefault(w, i)
    held = Counter(w for words in first for w in words)
    idf = {w: math.log(len(templates) / n) for w, n in held.items()}
    least = math.log(len(templates) / most)
    return {
        w: [(t, words[w]) for t, words in enumerate(first) if w in words] for w in sorted(held) if idf[w] >= least - 1e-9
    }


def _literal_postings(postings) -> Column:
    """One array of (word, template, position), grouped by word."""
    return F.array(*[
        F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(p).alias("p"))
        for w, places in postings.items()
        for t, p in places
    ])


def _starts(hits: Column, phrase: str) -> Column:
    """Positions where the words of a phrase stand consecutively; ``hits`` holds all places of those words in order."""
    words = phrase.split()

    def here(i):
        ok = None
        for k, w in enumerate(words):
            at = F.get(hits, i + k)
            one = (at["w"] == w) & (at["i"] == hits[i]["i"] + k)
            ok = one if ok is None else ok & one
        return F.coalesce(ok, F.lit(False))

    spots = F.filter(F.sequence(F.lit(0), F.size(hits) - 1), here)
    return F.when(F.size(hits) > 0, F.transform(spots, lambda i: hits[i]["i"])).otherwise(F.array().cast("array<int>"))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """The rows of ``docs`` plus ``n_words``, ``starts`` (starts of all phrase places, per place), ``base_labels`` (array),
    ``matches`` (array of label, offset, coverage of verified templates) and ``labels`` (array, both kinds).

    Whole texts are scanned; matching ignores the case of A-Z. Null and empty texts have no words and no labels. Repeated
    rows each get their own result; an empty table gives an empty result. Columns of the same names are replaced.
    """
    postings = rare_postings(templates)
    mandatory = [text.split() for _, _, text in templates]
    lookup = {w for words in mandatory for w in words} | {w for p in phrases for w in p.split()} | set(postings)
    sizes = [sum(t == x for places in postings.values() for x, _ in places) for t in range(len(templates))]
    # first places of the mandatory phrases inside their templates
    places = []
    for _, text, must in templates:
        words, need = text.split(), must.split()
        places.append(next(i for i in range(len(words)) if words[i : i + len(need)] == need))

    single = [
        sum((t, p + k) in postings.get(w, ()) for k, w in enumerate(need)) == 1 for t, (need, p) in enumerate(zip(mandatory, places))
    ]

    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), F.lit(WORD), F.lit(0))
    wanted = sorted(lookup)

    def scan(ws):
        marked = F.transform(ws, lambda w, i: F.when(w.isin(wanted), F.struct(w.alias("w"), i.alias("i"))))
        return F.struct(F.size(ws).alias("n"), F.array_compact(marked).alias("hits"), ws.alias("words"))

    out = docs.drop("n_words", "starts", "base_labels", "matches", "labels")
    out = out.withColumn("__scan", let(words, scan))
    hits = F.col("__scan.hits")
    table = _literal_postings(postings)
    vote = lambda h: F.transform(
        F.filter(table, lambda p: p["w"] == h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("off"))
    )
    rare = F.filter(hits, lambda h: h["w"].isin(sorted(postings)))

    single_words = [t for t, one in enumerate(single) if one]

    def agreeing(votes):
        """(vote, times) of the offsets with enough votes: sorted, equal votes are a run."""
        at = F.sequence(F.lit(0), F.size(votes) - 1)
        starts = F.filter(at, lambda j: (j == 0) | F.coalesce(F.get(votes, j - 1) != votes[j], F.lit(True)))

        def runs(first):
            end = lambda k: F.coalesce(F.get(first, k + 1), F.size(votes))
            return F.transform(first, lambda j, k: F.struct(votes[j].alias("v"), (end(k) - j).alias("n")))

        good = F.filter(let(starts, runs), lambda r: (r["n"] >= MIN_AGREEING) | r["v"]["t"].isin(single_words))
        return F.when(F.size(votes) > 0, good)

    labels = F.array(*[F.lit(label) for label, _, _ in templates])
    must = F.array(*[
        F.array(*[F.struct(F.lit(w).alias("w"), F.lit(p + k).alias("i")) for k, w in enumerate(words_)])
        for words_, p in zip(mandatory, places)
    ])
    total = F.array(*[F.lit(float(max(1, n))) for n in sizes])

    def matched(votes):
        # a phrase is verified at its places in the words, so the work grows with the votes, not with their square
        holds = lambda r: F.forall(
            must[r["v"]["t"]],
            lambda m: F.coalesce(F.get(F.col("__scan.words"), r["v"]["off"] + m["i"]) == m["w"], F.lit(False)),
        )
        score = lambda r: F.least(F.lit(1.0), r["n"] / F.element_at(total, r["v"]["t"] + 1))
        return F.transform(
            F.filter(agreeing(votes), holds),
            lambda r: F.struct(labels[r["v"]["t"]].alias("label"), r["v"]["off"].alias("off"), score(r).alias("coverage")),
        )

    none = F.array().cast("array<struct<label:string,off:int,coverage:double>>")
    votes = F.array_sort(F.flatten(F.transform(rare, vote)))
    out = out.withColumn("matches", F.when(F.size(rare) > 0, F.coalesce(let(votes, matched), none)).otherwise(none))
    starts = [(_starts(hits, phrase), label) for phrase, label in phrases.items()]
    out = out.withColumn("__starts", F.array(*[s for s, _ in starts]))
    base = F.array_compact(F.array(*[F.when(F.size(F.col("__starts")[k]) > 0, F.lit(label)) for k, (_, label) in enumerate(starts)]))
    out = out.withColumns({
        "n_words": F.col("__scan.n").cast("long"),
        "starts": F.array_sort(F.flatten("__starts")),
        "base_labels": F.array_sort(F.array_distinct(base)),
    })
    more = F.transform("matches", lambda m: m["label"])
    return out.withColumn("labels", F.array_sort(F.array_union("base_labels", more))).drop("__scan", "__starts")
