"""Quality classifier: gradient-boosted trees over document statistics.

A text becomes about two dozen statistics (sizes, byte classes, word shapes,
repetition of words, word pairs and lines).  Boosted trees are grown on the
driver from histograms of a bounded labelled sample, flattened into arrays,
and applied by vectorised traversal in the tasks that read the texts: one
pass, no shuffle, and a model of a few thousand numbers.

Defined results: null or empty texts get the score of the all-zero statistics
(a probability like any other); a text repeated in many rows gets the same
score in each; an empty table gives an empty result.  Without labelled rows
of both classes the score is the smoothed share of label 1 (0.5 with none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from . import textbatch as tb
from .samples import labelled_texts

# Byte classes: 0 other ASCII, 1 lower, 2 upper, 3 digit, 4 space, 5 line end,
# 6 sentence marks, 7 bars and brackets, 8 above ASCII.
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 32]], _CLASS[[10, 11, 12, 13]] = 4, 5
_CLASS[[ord(c) for c in ".,;:?'\""]] = 6
_CLASS[[ord(c) for c in "|<>{}[]()=+*/\\_#@&%$^~`"]] = 7
_CLASS[128:] = 8
_N_CLASS = 9

FEATURES = (
    ["log_bytes", "log_words", "log_lines", "word_len", "word_len_sd", "line_words"]
    + [f"share_{c}" for c in ("other", "lower", "upper", "digit", "space", "line_end", "mark", "bar", "high")]
    + ["exclaim", "word_distinct", "word_top", "pair_distinct", "pair_top", "line_distinct", "line_top",
       "word_repeat", "caps_words", "single_words", "mark_words"]
)


def _repetition(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct share and largest share of the keys of each document."""
    total = np.bincount(doc, minlength=n)
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(d)))
    distinct = np.bincount(d[first], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, d[first], size)
    floor = np.maximum(total, 1)
    return distinct / floor, top / floor


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` for each text of a byte run."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc_of_byte = np.repeat(np.arange(n), size)
    classes = np.bincount(doc_of_byte * _N_CLASS + _CLASS[data], minlength=n * _N_CLASS).reshape(n, _N_CLASS)
    exclaim = np.bincount(doc_of_byte[data == 33], minlength=n)
    begin, end, doc = tb.words(data, offsets, tb.SPACE)
    sums = tb.prefix_hash(tb.LOWER[data])
    key = tb.span_hash(sums, begin, end)
    length = (end - begin).astype(float)
    n_words = np.bincount(doc, minlength=n)
    some = np.maximum(n_words, 1)
    mean = np.bincount(doc, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(doc, length ** 2, n) / some - mean ** 2, 0))
    same = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    pair = tb.mix(key[same] * np.uint64(3) + key[same + 1]) if len(same) else np.zeros(0, np.uint64)
    repeat = np.bincount(doc[same][key[same] == key[same + 1]], minlength=n) if len(same) else np.zeros(n)
    newline = np.zeros(256, bool)
    newline[[10, 13]] = True
    lb, le, ld = tb.words(data, offsets, newline)
    line = tb.span_hash(sums, lb, le)
    n_lines = np.bincount(ld, minlength=n)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    lower = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    caps = (upper[end] - upper[begin] >= 2) & (lower[end] - lower[begin] == 0)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    marked = tb.NOT_WORD[last] if len(end) else np.zeros(0, bool)
    columns = [np.log1p(size), np.log1p(n_words), np.log1p(n_lines), mean, spread, n_words / np.maximum(n_lines, 1)]
    columns += list((classes / np.maximum(size, 1)[:, None]).T)
    columns += [exclaim / some, *_repetition(doc, key, n), *_repetition(doc[same], pair, n),
                *_repetition(ld, line, n), repeat / some,
                np.bincount(doc, caps, n) / some, np.bincount(doc, length == 1, n) / some,
                np.bincount(doc, marked, n) / some]
    return np.stack(columns, 1).astype(np.float64)


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as arrays: ``feature`` and ``threshold`` by
    (tree, inner node), ``value`` by (tree, leaf); a row goes right if its
    statistic exceeds the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        if len(self.feature):
            inner = self.feature.shape[1]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
            total = total + self.value[trees, at - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
               bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Gradient-boosted trees of logistic loss, split on histograms of ``bins`` quantile bins."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    empty = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    if len(y) == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    total = np.full(len(y), base)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            node = at - first
            best = np.full(width, 1e-9)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = node * bins + code[:, f]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(1)
                gl, hl = gs[:, :len(c)], hs[:, :len(c)]
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                gain[(hl < least) | (ht - hl < least)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[t, first:first + width][better] = f
                threshold[t, first:first + width][better] = c[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        leaf = at - inner
        value[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        total = total + value[t][leaf]
    return Forest(feature, threshold, value, base)


def _text_statistics(texts: pa.Array) -> np.ndarray:
    rows = [statistics(data, offsets) for _, _, data, offsets in tb.byte_runs(texts)]
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, held_out: int = 1,
        max_rows: int = 20_000) -> Forest:
    """Fit on at most ``max_rows`` labelled rows (see ``samples``); the driver
    gets one short row of statistics for each, never a text."""
    sample = labelled_texts(docs, labels, label, modulus, held_out, max_rows)
    fields = StructType([StructField("x", ArrayType(DoubleType()))])

    def work():
        def apply(texts: pa.Array) -> list[pa.Array]:
            x = _text_statistics(texts)
            return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))]
        return apply

    got = tb.annotate(sample, "text", ["label"], "s", fields, work).select("label", "s.x").collect()
    rows = sorted((int(r.label), tuple(r.x)) for r in got)
    x = np.array([r[1] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit_forest(x, np.array([r[0] for r in rows], float))


SCORE = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])


def score(docs: DataFrame, model: Forest, keep: list[str], text: str = "text", out: str = "quality",
          threshold: float = 0.5) -> DataFrame:
    """``docs[keep]`` and a struct ``out`` of ``score`` and ``predicted``."""

    def work():
        def apply(texts: pa.Array) -> list[pa.Array]:
            p = model.score(_text_statistics(texts))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
        return apply

    return tb.annotate(docs, text, keep, out, SCORE, work)
