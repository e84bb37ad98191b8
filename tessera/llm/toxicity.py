"""Toxic passages: maximum-scoring segments of token log-odds.

Each token (a word, or the stem it begins with) has a log-odds weight between
toxic and other documents under a Dirichlet prior (half a document, and ten
more spread as the pooled tokens are), taken at the lower end of its
confidence interval, minus a constant drift.  A linear-time scan finds every
maximal scoring segment of a document.

Scores of chance segments follow an extreme-value law: ``K n exp(-lambda S)``
segments of score ``S`` are expected in a clean document of ``n`` tokens.
Lambda is the root of ``E exp(lambda s) = 1`` over the scores of clean tokens,
K follows from the clean segments seen.  A segment whose expected number is
small is a toxic passage.  The document's evidence takes all its segments
together: the least probable sum of its best ``r``, for any ``r``.  A logistic
curve turns evidence into a probability.  Weights, lambda, K and the curve
come from the same rows by cross-fitting: a row is scored by the counts of the
parts it is not in.

One pass over the texts, no shuffle; the lexicon holds at most ``max_terms``
tokens (the size of the model).

Defined results: null, empty and word-free texts have no passage and get the
probability of a document without evidence; repeated rows get equal scores;
an empty table gives an empty result; without labelled toxic rows no token
has a positive weight and all documents get the smoothed share of label 1.
Equal-scoring ways to extend a segment keep the shorter one.  Of very long
texts all segments count, as of any other.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from . import textbatch as tb
from .samples import labelled_texts
from .shipping import ship


#: Lengths of stems in bytes.
STEMS = (4, 5, 6, 7, 8)
_LOW = np.uint64((1 << 18) - 1)


@dataclass(frozen=True)
class Lexicon:
    """Sorted token hashes and their scores (drift taken off), the score of any
    other token, the E-value constants and the calibration."""

    key: np.ndarray
    weight: np.ndarray
    other: float
    lam: float = 1.0
    k: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0
    e_max: float = 0.05

    def scores(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Each token's score: the best of its own entry and those of its
        stems.  A word says less each time a document repeats it: from the
        fourth time on it has three times its score over how often it came."""
        out = np.full(len(begin), self.other)
        if not len(self.key):
            return out
        maybe = np.zeros(1 << 18, bool)  # most lookups end at this table
        maybe[self.key & _LOW] = True
        whole = np.zeros(0, np.uint64)
        for at, key in token_keys(data, begin, end):
            if not len(whole):
                whole = key
            some = np.flatnonzero(maybe[key & _LOW])
            got = key[some]
            i = np.minimum(np.searchsorted(self.key, got), len(self.key) - 1)
            hit = self.key[i] == got
            np.maximum.at(out, at[some[hit]], self.weight[i[hit]])
        hot = np.flatnonzero(out > 0)
        order = hot[np.lexsort((hot, whole[hot], doc[hot]))]
        new = np.ones(len(order), bool)
        new[1:] = (whole[order][1:] != whole[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        at = np.arange(len(order))
        time = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        out[order] *= np.minimum(1, 3 / time)
        return out

    def evidence(self, score: float, n: int) -> float:
        """Minus the log of the number of such segments expected by chance."""
        return self.lam * score - float(np.log(self.k * max(n, 1)))

    def document(self, scores: list[float], n: int) -> float:
        """Evidence of all segments of a document: minus the log probability
        of the least probable sum of its best ``r``, corrected for the choice
        of ``r`` (0: what a clean document has)."""
        x = np.array([self.evidence(s, n) for s in sorted(scores, reverse=True)])
        total = np.cumsum(x)
        r = np.arange(1, len(x) + 1)
        factorial = np.concatenate([[0.0], np.cumsum(np.log(r))])
        rare = total - (r - 1) * np.log(np.maximum(total, 1)) + factorial[1:] + factorial[:-1] - r * np.log(2)
        return float(max(rare[total > 0].max(initial=0.0), 0.0))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        z = self.intercept + self.slope * np.log1p(evidence)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def token_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """``(token numbers, keys)``: of the whole tokens, then of their stems, the
    first 4 to 8 bytes of each longer token (inflected forms share a stem)."""
    sums = tb.prefix_hash(tb.LOWER[data])
    yield np.arange(len(begin)), tb.span_hash(sums, begin, end)
    for n in STEMS:
        at = np.flatnonzero(end - begin > n)
        yield at, ~tb.span_hash(sums, begin[at], begin[at] + n)


def segments(position: list[int], score: list[float], before: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a token sequence.

    Only positive tokens are listed, each with the running total of all
    earlier tokens (``before``).  Every step closes or extends a candidate,
    so the scan is linear in the tokens.
    """
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    for at, s, low in zip(position, score, before, strict=True):
        start, high = at, low + s
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= low:
                j -= 1
            if j < 0 or right[j] >= high:
                break
            start, low = span[j][0], left[j]
            del left[j:], right[j:], span[j:]
        left.append(low)
        right.append(high)
        span.append((start, at))
    return [(a, b, r - lo) for (a, b), lo, r in zip(span, left, right, strict=True)]


def run_segments(lexicon: Lexicon, data: np.ndarray, offsets: np.ndarray):
    """Word spans of a byte run, words by document, and ``{doc: segments}``."""
    begin, end, doc = tb.words(data, offsets, tb.NOT_WORD)
    s = lexicon.scores(data, begin, end, doc)
    total = np.cumsum(s)
    n_words = np.bincount(doc, minlength=len(offsets) - 1)
    hot = np.flatnonzero(s > 0)
    found = {}
    if len(hot):
        edges = np.flatnonzero(np.diff(doc[hot], prepend=-1, append=len(offsets)))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at = hot[a:b]
            found[int(doc[at[0]])] = segments(at.tolist(), s[at].tolist(), (total[at] - s[at]).tolist())
    return begin, end, n_words, found


def _documents(lexicon: Lexicon, texts: pa.Array):
    """``(evidence, passages)`` of each text; a passage is (begin, end, text,
    score, evidence) with byte offsets."""
    for _, _, data, offsets in tb.byte_runs(texts):
        begin, end, n_words, found = run_segments(lexicon, data, offsets)
        for i, n in enumerate(n_words.tolist()):
            out = []
            segs = found.get(i, ())
            for a, b, s in segs:
                e = lexicon.evidence(s, n)
                if e > -np.log(lexicon.e_max):
                    lo, hi = int(begin[a]), int(end[b])
                    out.append((lo - int(offsets[i]), hi - int(offsets[i]),
                                bytes(data[lo:hi]).decode("utf-8", "replace"), s, e))
            yield lexicon.document([s for _, _, s in segs], n), out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps; negative slopes are set to 0."""
    x = np.column_stack([np.ones(len(y)), x])
    use = np.ones(x.shape[1], bool)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + ridge * (w @ w) / 2)

    while True:
        w = np.zeros(x.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            slope = (x.T @ (y - p) - ridge * w)[use]
            bend = ((x * (p * (1 - p))[:, None]).T @ x)[np.ix_(use, use)] + ridge * np.eye(int(use.sum()))
            step = np.zeros_like(w)
            step[use] = np.linalg.solve(bend, slope)
            size = 1.0
            while size > 1e-6 and loss(w + size * step) > loss(w):
                size /= 2
            w = w + size * step
        if (w[1:] >= 0).all():
            return w
        use[1:] &= w[1:] >= 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, held_out: int = 1,
        max_rows: int = 20_000, min_docs: int = 3, max_terms: int = 200_000, prior: float = 10.0,
        z: float = 1.65, drift: float = 0.5) -> Lexicon:
    """Fit on at most ``max_rows`` labelled rows (see ``samples``).

    Tokens are counted by documents (a Spark aggregation), apart for each of
    three parts; those in ``min_docs`` documents or more whose weight is above
    the drift make the lexicon, with toxic documents counted by different
    contexts of the token.  The driver receives the lexicon, two histograms of
    scores and one number for each row of the sample.
    """
    ship(docs.sparkSession)
    sample = labelled_texts(docs, labels, label, modulus, held_out, max_rows)
    sizes = {(r["part"], r["label"]): r["n"] for r in sample.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
    names = [f"{kind}{part}" for part in range(3) for kind in ("neg", "pos")]
    spec = StructType([StructField("key", LongType()), *(StructField(n, LongType()) for n in names)])

    def count(batches):
        for batch in batches:
            group = np.asarray(batch.column("part")) * 2 + np.asarray(batch.column("label"))
            for first, last, data, offsets in tb.byte_runs(batch.column("text")):
                begin, end, doc = tb.words(data, offsets, tb.NOT_WORD)
                pairs = [(doc[at], key) for at, key in token_keys(data, begin, end)]
                doc = np.concatenate([d for d, _ in pairs])
                key = np.concatenate([k for _, k in pairs])
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                key, own = key[new], group[first:last][doc[new]]
                uniq, at = np.unique(key, return_inverse=True)
                found = [pa.array(np.bincount(at, own == g, len(uniq)).astype(np.int64)) for g in range(6)]
                yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), *found], names=spec.names)

    counts = sample.mapInArrow(count, spec).groupBy("key").agg(*[F.sum(n).alias(n) for n in names])

    # three lexicons that leave a part out, and the one of all parts
    folds = [[p for p in range(3) if p != part] for part in range(3)] + [[0, 1, 2]]
    size = [[float(sum(sizes.get((p, y), 0) for p in parts)) for y in (0, 1)] for parts in folds]

    def weight(pos, neg, n0: float, n1: float, log, root):
        """Lower end of the log-odds of a token in ``pos`` of ``n1`` toxic and ``neg`` of ``n0`` other documents."""
        alpha = (pos + neg) * (prior / max(n1 + n0, 1.0)) + 0.5
        whole = prior + 1.0
        odds = log((pos + alpha) / (n1 + whole - pos - alpha)) - log((neg + alpha) / (n0 + whole - neg - alpha))
        return odds - z * root(1 / (pos + alpha) + 1 / (neg + alpha))

    def of(kind: str, parts: list[int]):
        return sum((F.col(f"{kind}{p}") for p in parts), F.lit(0))

    by_docs = [F.when(of("pos", parts) + of("neg", parts) >= min_docs,
                      weight(of("pos", parts), of("neg", parts), *size[i], F.log, F.sqrt)) for i, parts in enumerate(folds)]
    rows = (counts.withColumn("w", F.greatest(*by_docs)).where(F.col("w") > drift)
            .orderBy(F.desc("w"), "key").limit(max_terms).collect())
    rows.sort(key=lambda r: r["key"] % (1 << 64))
    key = np.array([r["key"] % (1 << 64) for r in rows], np.uint64)
    seen = np.array([[r[n] for n in names] for r in rows], float).reshape(-1, 6)
    alone = _contexts(sample, key, folds)
    lexicons = []
    for i, parts in enumerate(folds):
        neg, pos = (sum(seen[:, 2 * p + y] for p in parts) for y in (0, 1))
        pos = np.minimum(pos, alone[:, i])
        w = weight(pos, neg, *size[i], np.log, np.sqrt) - drift
        use = (pos + neg >= min_docs) & (w > 0)
        lexicons.append(Lexicon(key[use], w[use], -drift))
    return _calibrate(sample, lexicons)


def _contexts(sample: DataFrame, key: np.ndarray, folds: list[list[int]]) -> np.ndarray:
    """In how many different contexts (the words before and after) each token
    stands in toxic rows, for each choice of parts.

    All copies of a text have the same contexts, so however many there are,
    they are evidence for their tokens once.
    """
    spec = StructType([StructField("at", LongType()), StructField("context", LongType()), StructField("parts", IntegerType())])
    sent = sample.sparkSession.sparkContext.broadcast(key)

    def run(batches):
        key = sent.value
        for batch in batches:
            part = np.asarray(batch.column("part"))
            for first, last, data, offsets in tb.byte_runs(batch.column("text")):
                begin, end, doc = tb.words(data, offsets, tb.NOT_WORD)
                word = tb.span_hash(tb.prefix_hash(tb.LOWER[data]), begin, end)
                side = np.zeros(len(word) + 2, np.uint64)
                side[1:-1] = word
                same = np.ones(len(word) + 1, bool)  # whether a word follows one of its own text
                same[0] = same[-1] = False
                same[1:-1] = doc[1:] == doc[:-1]
                around = tb.mix(np.where(same[:-1], side[:-2], np.uint64(0)) + np.uint64(1)) ^ np.where(same[1:], side[2:], np.uint64(0))
                found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                for at, own in token_keys(data, begin, end):
                    i = np.minimum(np.searchsorted(key, own), max(len(key) - 1, 0))
                    hit = key[i] == own if len(key) else np.zeros(len(own), bool)
                    found.append((i[hit], around[at[hit]], 1 << part[first:last][doc[at[hit]]].astype(np.int64)))
                at, context, mask = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(context.view(np.int64)), pa.array(mask.astype(np.int32))], names=spec.names)

    pairs = sample.where("label = 1").select("text", "part").mapInArrow(run, spec).groupBy("at", "context").agg(
        F.bit_or("parts").alias("parts"))
    chosen = [F.count(F.when(F.col("parts").bitwiseAND(sum(1 << p for p in parts)) != 0, 1)).alias(f"n{i}")
              for i, parts in enumerate(folds)]
    out = np.zeros((len(key), len(folds)))
    if len(key):
        for r in pairs.groupBy("at").agg(*chosen).collect():
            out[r["at"]] = [r[f"n{i}"] for i in range(len(folds))]
    return out


def _by_part(sample: DataFrame, lexicons: list[Lexicon], spec: StructType, work) -> DataFrame:
    """``work(lexicon, texts, labels)`` makes the columns of a batch; a row's
    lexicon is the one without its part."""
    sent = sample.sparkSession.sparkContext.broadcast(lexicons)

    def run(batches):
        for batch in batches:
            part = np.asarray(batch.column("part"))
            for p in range(3):
                at = pa.array(np.flatnonzero(part == p))
                if len(at):
                    own = batch.take(at)
                    yield pa.RecordBatch.from_arrays(
                        work(sent.value[p], own.column("text"), np.asarray(own.column("label"))), names=spec.names)

    return sample.select("text", "label", "part").mapInArrow(run, spec)


#: Scores are counted in hundredths, up to this.
_TOP = 100.0


def _scores(sample: DataFrame, lexicons: list[Lexicon]) -> tuple[dict[float, int], dict[float, int], int]:
    """How often clean tokens above the drift and clean segments have each
    score, and the number of clean tokens."""
    spec = StructType([StructField("kind", IntegerType()), StructField("bin", LongType()), StructField("n", LongType())])

    def work(lexicon: Lexicon, texts: pa.Array, label: np.ndarray) -> list[pa.Array]:
        texts = texts.filter(pa.array(label == 0))
        found: list[tuple[int, int, int]] = []
        for _, _, data, offsets in tb.byte_runs(texts):
            begin, end, doc = tb.words(data, offsets, tb.NOT_WORD)
            s = lexicon.scores(data, begin, end, doc)
            found.append((0, 0, len(s)))
            _, _, _, segs = run_segments(lexicon, data, offsets)
            seg = np.array([x[2] for v in segs.values() for x in v])
            for kind, x in ((1, s[s > 0]), (2, seg)):
                bins, n = np.unique(np.ceil(np.minimum(x, _TOP) * 100).astype(np.int64), return_counts=True)
                found += [(kind, b, c) for b, c in zip(bins.tolist(), n.tolist(), strict=True)]
        column = list(zip(*found, strict=True)) if found else [[]] * 3
        return [pa.array(column[0], pa.int32()), pa.array(column[1], pa.int64()), pa.array(column[2], pa.int64())]

    rows = _by_part(sample, lexicons, spec, work).groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect()
    by = [{r["bin"] / 100: r["n"] for r in rows if r["kind"] == kind} for kind in range(3)]
    return by[1], by[2], sum(by[0].values())


def chance(tokens: dict[float, int], segs: dict[float, int], n: int, other: float, typical: float) -> tuple[float, float]:
    """Lambda and K of clean texts with ``n`` tokens, ``other`` each but for
    ``tokens``; one more token of a typical weight counts, so that there is one."""
    score = np.array([*tokens, typical])
    count = np.array([*tokens.values(), 1.0])
    rest = max(n - count.sum() + 1, 1.0)
    total = rest + count.sum()

    def excess(lam: float) -> float:
        return float((rest * np.exp(lam * other) + (count * np.exp(np.minimum(lam * score, 700))).sum()) / total - 1)

    if rest * other + (count * score).sum() >= 0:
        return 1e-3, 1.0  # no drift left: nothing is significant
    low, high = 0.0, 1.0
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    lam = high
    seen = np.array([[s, c] for s, c in sorted(segs.items())]).reshape(-1, 2)
    half = float(seen[:, 1].sum()) / 2
    level = float(seen[np.searchsorted(np.cumsum(seen[:, 1]), half), 0]) if len(seen) else typical
    above = float(seen[seen[:, 0] >= level, 1].sum())
    return lam, (above + 1) / (total * float(np.exp(-min(lam * level, 700))))


def _calibrate(sample: DataFrame, lexicons: list[Lexicon]) -> Lexicon:
    """The lexicon of all parts with lambda, K and the logistic curve."""
    final = lexicons[3]
    if len(final.weight):
        tokens, segs, n = _scores(sample, lexicons)
        lam, k = chance(tokens, segs, n, final.other, float(np.median(final.weight)))
    else:
        lam, k = 1.0, 1.0
    lexicons = [replace(x, lam=lam, k=k) for x in lexicons]
    spec = StructType([StructField("label", IntegerType()), StructField("evidence", DoubleType())])

    def work(lexicon: Lexicon, texts: pa.Array, label: np.ndarray) -> list[pa.Array]:
        return [pa.array(label.astype(np.int32)), pa.array([e for e, _ in _documents(lexicon, texts)], pa.float64())]

    rows = sorted((r["label"], r["evidence"]) for r in _by_part(sample, lexicons, spec, work).collect())
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return replace(lexicons[3], intercept=float(np.log(share / (1 - share))))
    w = _logistic(np.log1p([[r[1]] for r in rows]), y)
    return replace(lexicons[3], intercept=float(w[0]), slope=float(w[1]))


RESULT = StructType([
    StructField("score", DoubleType()), StructField("predicted", IntegerType()),
    StructField("passages", ArrayType(StructType([
        StructField("begin", LongType()), StructField("end", LongType()), StructField("text", StringType()),
        StructField("score", DoubleType()), StructField("evidence", DoubleType())]))),
])


def score(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text", out: str = "toxicity",
          threshold: float = 0.7) -> DataFrame:
    """``docs[keep]`` and a struct ``out``: the probability, the decision and
    every significant passage (byte offsets into the UTF-8 text)."""
    passage = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("text", pa.string()),
                                  ("score", pa.float64()), ("evidence", pa.float64())]))

    def work():
        def apply(texts: pa.Array) -> list[pa.Array]:
            found = list(_documents(lexicon, texts))
            p = lexicon.probability(np.array([e for e, _ in found], float))
            names = ("begin", "end", "text", "score", "evidence")
            listed = [[dict(zip(names, x, strict=True)) for x in doc] for _, doc in found]
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(listed, passage)]
        return apply

    return tb.annotate(docs, text, keep, out, RESULT, work)
