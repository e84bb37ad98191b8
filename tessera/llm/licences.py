"""Licence notices: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines) are bags of hashed word 1- to 3-grams.  A multinomial
logistic regression, trained on varied copies of the notices below, on notices
with the licence's name replaced, and on ordinary paragraphs, gives the family
or the unknown class; a temperature fitted on held-out copies calibrates the
probabilities.  A family counts only if the paragraph also shares enough word
3-grams with one of the family's notices.  Notices wrapped over several lines
are looked up by their 3-grams across line breaks and classified as one
paragraph (``Wrapped``); where a line alone is a finding of the family, that
line stands.

One pass over the texts, no shuffle; the model is a fixed number of weights.

Defined results: null, empty and notice-free texts have no findings; repeated
rows get equal ones; of equal probabilities the family first in ``FAMILIES``
wins; copyright lines and proprietary notices are a family of their own
(``RESERVED``); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from . import textbatch as tb

# Common notices of each licence family.
FAMILIES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright 2020",
        "Copyright (c) 2020",
        "Copyright \u00a9 2020",
        "\u00a9 2020",
        "This software is proprietary and confidential; unauthorized copying, distribution or use is strictly prohibited without prior written permission",
    ],
}
#: The family that grants nothing: a document's licence is another one if it has one.
RESERVED = "all-rights-reserved"
_BITS = 16
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True
#: All years from 1900 to 2099 are one word.
_YEAR = np.uint64(0x59454152)


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Lines ``(begin, end, doc)``, word n-grams ``(line, hash, n)`` within
    lines, and ``(line of each word, n-gram hashes at each word by n)``
    whatever lines and texts they run over."""
    begin, end, doc = tb.words(data, offsets, _LINE)
    wb, we, _ = tb.words(data, np.append(begin, len(data)) if len(begin) else offsets, tb.NOT_WORD)
    line = np.searchsorted(begin, wb, "right") - 1
    word = tb.span_hash(tb.prefix_hash(tb.LOWER[data]), wb, we)
    four = np.flatnonzero(we - wb == 4)
    digits = data[wb[four][:, None] + np.arange(4)].astype(np.int64) - 48
    century = digits[:, 0] * 10 + digits[:, 1]
    word[four[((digits >= 0) & (digits <= 9)).all(1) & ((century == 19) | (century == 20))]] = _YEAR
    out, h, across = [(line, word, np.ones(len(word), np.int64))], word, {1: word}
    for n in (2, 3):
        if len(word) < n:
            break
        same = line[n - 1:] == line[:len(line) - n + 1]
        h = across[n] = tb.mix(h[:len(word) - n + 1] * np.uint64(3) + word[n - 1:] + np.uint64(n))
        out.append((line[n - 1:][same], h[same], np.full(int(same.sum()), n, np.int64)))
    return begin, end, doc, tuple(np.concatenate(c) for c in zip(*out, strict=True)), (line, across)


def _of(text: str):
    data = np.frombuffer(text.replace("\n", " ").encode(), np.uint8)
    _, _, _, (_, h, n), _ = _grams(data, np.array([0, len(data)]))
    return h, n


class Wrapped:
    """Finds notices that run over several lines.

    A notice's n-grams are looked up whatever line breaks they run over, so
    wrapping, indents and comment marks don't matter.  Hits of one notice no
    further apart than its length make an occurrence; a new one begins where
    the order of the notice starts again and enough of it has been seen.
    """

    def __init__(self, families: list[list[str]]):
        known: dict[int, list[tuple[int, int]]] = {}
        self.family, self.size, self.words = [], [], []
        for k, notices in enumerate(families):
            for notice in notices:
                h, n = _of(notice)
                own = dict.fromkeys(h[n == min(3, n.max())].tolist())
                for place, gram in enumerate(own):
                    known.setdefault(gram, []).append((len(self.size), place))
                self.family.append(k)
                self.size.append(len(own))
                self.words.append(int((n == 1).sum()))
        self.known = np.array(sorted(known), np.uint64)
        entries = [known[g] for g in self.known.tolist()]
        self.count = np.array([len(e) for e in entries])
        self.start = np.cumsum(self.count) - self.count
        self.notice, self.place = np.array([x for e in entries for x in e]).T
        #: pairs of families whose notices share n-grams
        self.related = {(self.family[s], self.family[t]) for e in entries for s, _ in e for t, _ in e}

    def find(self, line: np.ndarray, doc: np.ndarray, across: dict[int, np.ndarray], least: float):
        """``(likeness, family, first word, last word)`` of occurrences over several lines."""
        hits = []
        for n in (2, 3):
            if n not in across:
                continue
            slot = np.minimum(np.searchsorted(self.known, across[n]), len(self.known) - 1)
            at = np.flatnonzero(self.known[slot] == across[n])
            at = at[doc[line[at]] == doc[line[at + n - 1]]]
            times = self.count[slot[at]]
            entry = np.repeat(self.start[slot[at]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(at, times)
            hits.append((self.notice[entry], at, at + n - 1, self.place[entry]))
        if not hits:
            return []
        notice, first, last, place = (np.concatenate(c) for c in zip(*hits, strict=True))
        order = np.lexsort((first, notice))
        notice, first, last, place = notice[order], first[order], last[order], place[order]
        if not len(notice):
            return []
        size, words = np.array(self.size), np.array(self.words)
        new = np.ones(len(notice), bool)
        new[1:] = ((notice[1:] != notice[:-1]) | (first[1:] - first[:-1] > words[notice[1:]])
                   | (doc[line[first[1:]]] != doc[line[first[:-1]]]))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(notice))
        open_ = (line[first[begin]] != line[last[end - 1]]) & (end - begin >= least * size[notice[begin]])
        out = []

        def done(a: int, b: int, t: int, seen: set) -> None:
            if len(seen) >= least * self.size[t] and line[first[a]] != line[last[b - 1]]:
                out.append((len(seen) / self.size[t], self.family[t], int(first[a]), int(last[b - 1])))

        for a, b in zip(begin[open_].tolist(), end[open_].tolist(), strict=True):
            t, seen, since = int(notice[a]), set(), a
            for i, x in zip(range(a, b), place[a:b].tolist(), strict=True):
                if i > since and x <= place[i - 1] and len(seen) >= least * self.size[t]:
                    done(since, i, t, seen)
                    seen, since = set(), i
                seen.add(x)
            done(since, b, t, seen)
        return out


@dataclass(frozen=True)
class Model:
    """Weights by hashed n-gram and class (the last is unknown), the
    temperature, and the 3-gram hashes of the notices by family (2-grams of a
    notice of two words)."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    names: tuple[str, ...]
    templates: tuple[tuple[np.ndarray, ...], ...]

    def probabilities(self, line: np.ndarray, h: np.ndarray, n_lines: int) -> np.ndarray:
        z = np.tile(self.bias, (n_lines, 1))
        slot = (h >> np.uint64(64 - _BITS)).astype(np.int64)
        size = np.maximum(np.bincount(line, minlength=n_lines), 1) ** 0.5
        for k in range(z.shape[1]):
            z[:, k] += np.bincount(line, self.weights[slot, k], n_lines) / size
        z = z / self.temperature
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(1, keepdims=True)

    def likeness(self, family: int, h: np.ndarray) -> float:
        """The largest share of a notice's 3-grams that are in the paragraph's n-grams ``h``."""
        return max(float(np.isin(t, h).mean()) if len(t) else 0.0 for t in self.templates[family])


def ordinary_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_docs: int = 300,
                   likeness: float = 0.5, longest: int = 2000) -> list[str]:
    """Different lines without notices: two, at hashed positions, of each text
    of the ``max_docs`` ids with the smallest hash, at most ``2 * max_docs``.

    Of a line above ``longest`` characters a part at a hashed position is taken.
    A line counts as a notice if it holds ``likeness`` of a notice's n-grams or
    a notice holds ``likeness`` of its 3-grams (a line of a wrapped notice).
    """
    # ids first: at most max_docs of them are broadcast, and only their lines come back
    chosen = (docs.where(docs[text].isNotNull() & docs[doc_id].isNotNull()).select(docs[doc_id].alias("__id")).distinct()
              .orderBy(F.xxhash64("__id"), "__id").limit(max_docs))
    lines = F.filter(F.split(F.col("__text"), "[\r\n]"), lambda x: x.rlike(r"\S"))
    texts = docs.select(docs[doc_id].alias("__doc"), docs[text].alias("__text"))
    several = (texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
               .select("__id", F.xxhash64("__text").alias("__key"), lines.alias("__lines")).where(F.size("__lines") > 0)
               .withColumn("__turn", F.explode(F.array(F.lit(0), F.lit(1)))))
    line = F.element_at("__lines", (F.pmod(F.xxhash64("__id", "__key", "__turn"), F.size("__lines")) + 1).cast("int"))
    at = F.pmod(F.xxhash64("__key", "__turn"), F.greatest(F.length("line") - longest, F.lit(0)) + 1) + 1
    drawn = several.select(line.alias("line"), "__key", "__turn").select(F.col("line").substr(at.cast("int"), F.lit(longest)).alias("line"))
    rows = drawn.distinct().orderBy(F.xxhash64("line"), "line").limit(2 * max_docs).collect()
    notices = [np.unique(h[n == min(3, n.max())]) for f in FAMILIES.values() for h, n in map(_of, f)]
    every = np.unique(np.concatenate(notices))

    def ordinary(line: str) -> bool:
        h, n = _of(line)
        triples = h[n == 3]
        return (all(np.isin(t, h).mean() < likeness for t in notices)
                and not (len(triples) and np.isin(triples, every).mean() >= likeness))

    return sorted(r.line for r in rows if r.line.strip() and ordinary(r.line))


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_docs: int = 300, copies: int = 40,
        epochs: int = 30, seed: int = 7) -> Model:
    """Train on copies of the notices and on :func:`ordinary_lines`."""
    rng = np.random.default_rng(seed)
    ordinary = ordinary_lines(docs, text, doc_id, max_docs)
    names = tuple(FAMILIES)
    unknown = len(names)
    key_words = {"apache", "mit", "gnu", "general", "lesser", "public", "bsd", "mozilla", "creative", "commons",
                 "cc", "by", "nc", "sa", "cc0", "noncommercial", "sharealike", "attribution"}
    samples: list[tuple[str, int]] = []

    def invented() -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))

    for k, family in enumerate(names):
        for notice in FAMILIES[family]:
            words = notice.split()
            for c in range(copies):
                kept = [w for w in words if c == 0 or rng.random() > 0.08]
                lead = ["", "Note: ", "# ", "// ", "Copyright 2020. "][c % 5]
                if family == RESERVED:  # an owner in some; a lead of its own would be the notice
                    lead, kept = ["", "# ", "// "][c % 3], (kept if len(words) > 3 else words) + [invented() for _ in range(c % 4)]
                samples.append((lead + " ".join(kept), k))
                masked = [invented() if w.lower().strip(".,-;()") in key_words or "-" in w else w for w in words]
                if masked != words and c % 2 == 0:
                    samples.append((("" if c % 5 == 4 else lead) + " ".join(masked), unknown))
    samples += [(line, unknown) for line in ordinary]
    order = rng.permutation(len(samples))
    feats = [((_of(samples[i][0])[0] >> np.uint64(64 - _BITS)).astype(np.int64), samples[i][1]) for i in order]
    feats = [(np.unique(f), y) for f, y in feats if len(f)]
    held, train = feats[: len(feats) // 5], feats[len(feats) // 5:]
    w = np.zeros((1 << _BITS, unknown + 1))
    b = np.zeros(unknown + 1)

    def logits(f: np.ndarray) -> np.ndarray:
        return w[f].sum(0) / np.sqrt(len(f)) + b

    for epoch in range(epochs):
        rate = 2.0 / (1 + 0.2 * epoch)
        for i in rng.permutation(len(train)):
            f, y = train[i]
            z = logits(f)
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y] -= 1
            w[f] -= rate * (g / np.sqrt(len(f)) + 1e-4 * w[f])
            b -= 0.1 * rate * g
    zs, ys = np.array([logits(f) for f, _ in held]), np.array([y for _, y in held])

    def loss(t: float) -> float:
        z = zs / t
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(ys)), ys]).mean())

    temperature = min(np.geomspace(0.5, 5, 20).tolist(), key=loss)
    triples = tuple(tuple(np.unique(h[n == min(3, n.max())]) for h, n in map(_of, FAMILIES[f])) for f in names)
    return Model(w.astype(np.float32), b, temperature, names, triples)


RESULT = StructType([
    StructField("n_paragraphs", LongType()),
    StructField("findings", ArrayType(StructType([
        StructField("family", StringType()), StructField("probability", DoubleType()),
        StructField("likeness", DoubleType()), StructField("begin", LongType()), StructField("end", LongType())])))])


def scan(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: str = "licence",
         least: float = 0.5, likeness: float = 0.5) -> DataFrame:
    """``docs[keep]`` and a struct ``out``: how many paragraphs there are, and
    every confirmed notice with the byte span of its lines."""
    spec = pa.list_(pa.struct([("family", pa.string()), ("probability", pa.float64()), ("likeness", pa.float64()),
                               ("begin", pa.int64()), ("end", pa.int64())]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        model = sent.value
        wrapped = Wrapped([FAMILIES[f] for f in model.names])

        def apply(texts: pa.Array) -> list[pa.Array]:
            count, found = [], []
            for _, _, data, offsets in tb.byte_runs(texts):
                n = len(offsets) - 1
                begin, end, doc, (line, h, size), (lines, across) = _grams(data, offsets)
                count += np.bincount(doc, minlength=n).tolist()
                own: list[dict] = [{} for _ in range(n)]
                by_line: dict[int, dict] = {}

                def add(a: int, b: int, k: int, p: float, like: float) -> None:
                    """The finding of the words a to b - 1: their lines' span."""
                    i, j = int(lines[a]), int(lines[b - 1])  # noqa: B023
                    base = int(offsets[doc[i]])  # noqa: B023
                    f = {"family": model.names[k], "probability": p, "likeness": like,
                         "begin": int(begin[i]) - base, "end": int(end[j]) - base}  # noqa: B023
                    own[doc[i]][a, b, k] = f  # noqa: B023
                    for x in range(i, j + 1):
                        by_line.setdefault(x, {})[a, b, k] = f  # noqa: B023

                p = model.probabilities(line, h, len(begin))
                best = p[:, :-1].argmax(1) if len(begin) else np.zeros(0, np.int64)
                hits = np.flatnonzero(p[np.arange(len(begin)), best] >= least)
                several = [(line[size == n], h[size == n]) for n in (2, 3)]  # each in line order
                for i in hits.tolist():
                    own_h = [nh[slice(*np.searchsorted(nl, [i, i + 1]))] for nl, nh in several]
                    like = model.likeness(int(best[i]), np.concatenate(own_h))
                    if like >= likeness:
                        add(*np.searchsorted(lines, [i, i + 1]).tolist(), int(best[i]), float(p[i, best[i]]), like)
                for like, k, a, b in sorted(wrapped.find(lines, doc, across, likeness), key=lambda x: (-x[0], x[2:], x[1])):
                    grams = np.concatenate([across[n][a:b + 2 - n] for n in across])
                    run_p = model.probabilities(np.zeros(len(grams), np.int64), grams, 1)[0]
                    if run_p[:-1].argmax() != k or run_p[k] < least:
                        continue
                    # of findings of related notices in the same words the likest stays
                    there = {key: f for x in range(lines[a], lines[b] + 1) for key, f in by_line.get(x, {}).items()}
                    same = {key: f for key, f in there.items()
                            if key[0] <= b and key[1] > a and (key[2], k) in wrapped.related}
                    if all(key[2] != k and f["likeness"] < like for key, f in same.items()):
                        for key in same:
                            own[doc[lines[a]]].pop(key)
                            for x in range(lines[key[0]], lines[key[1] - 1] + 1):
                                by_line[x].pop(key)
                        add(a, b + 1, k, float(run_p[k]), like)
                found += [[x[key] for key in sorted(x)] for x in own]
            return [pa.array(count, pa.int64()), pa.array(found, spec)]
        return apply

    return tb.annotate(docs, text, keep, out, RESULT, work)
