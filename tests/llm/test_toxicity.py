"""Toxic passages: the scan against brute force, copies, and the bound of the sample."""

import math
import random

import numpy as np
import pyarrow as pa

from tessera.llm import quality, toxicity
from tessera.llm import textbatch as tb
from tessera.llm.samples import labelled_texts


def best(scores, first, last):
    """The maximal segments of ``scores[first:last]``: the best one, and those on both sides of it."""
    found = [(sum(scores[a:b]), -(b - a), a, b) for a in range(first, last) for b in range(a + 1, last + 1)]
    top = max(found, default=None)
    if top is None or top[0] <= 0:
        return []
    _, _, a, b = top
    return [*best(scores, first, a), (a, b - 1, sum(scores[a:b])), *best(scores, b, last)]


def test_segments_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-1, -1, 1]) * rng.random() * rng.choice([1, 3]) for _ in range(rng.randint(1, 25))]
        total = np.cumsum(scores)
        at = [i for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(at, [scores[i] for i in at], [float(total[i] - scores[i]) for i in at])
        want = best(scores, 0, len(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(math.isclose(x[2], y[2], abs_tol=1e-9) for x, y in zip(got, want, strict=True))


def keyed(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    begin, end, _ = tb.words(data, np.array([0, len(data)]), tb.NOT_WORD)
    return next(toxicity.token_keys(data, begin, end))[1]


def test_evidence_of_all_segments_and_of_long_texts():
    key = np.sort(keyed(["bad"]))
    lexicon = toxicity.Lexicon(key, np.array([4.0]), -0.5, lam=1.0, k=0.1, intercept=-3.0, slope=2.0)
    far = " ".join(["word"] * 40)
    texts = [None, "", "word word", "bad", f"bad {far} bad", "bad bad", "bad " * 400, "word " * 300_000, "word " * 300_000 + "bad"]
    got = list(toxicity._documents(lexicon, pa.array(texts)))
    evidence = [e for e, _ in got]
    assert evidence[:3] == [0, 0, 0] and evidence[7] == evidence[8] == 0  # once in 300,000 words is chance
    assert 0 < evidence[4] < evidence[3] < evidence[5] < evidence[6]
    # the fourth time on, a word says less: 4 * (3 + 3 * (1/4 + ... + 1/400))
    assert math.isclose(got[6][1][0][3], 4 * (3 + sum(3 / k for k in range(4, 401))), rel_tol=1e-9)
    assert [len(p) for _, p in got] == [0, 0, 0, 1, 0, 1, 1, 0, 0]
    p = lexicon.probability(np.array(evidence))
    assert p[0] == p[7] < p[4] < p[3] < p[5]


def test_lambda_solves_its_equation():
    tokens = {2.0: 50, 3.5: 10}
    lam, k = toxicity.chance(tokens, {2.0: 40, 5.0: 5}, 10_000, -0.5, 2.0)
    count = {**tokens, 2.0: 51}
    rest = 10_000 - 60
    mean = (rest * math.exp(-0.5 * lam) + sum(c * math.exp(s * lam) for s, c in count.items())) / (rest + 61)
    assert math.isclose(mean, 1, rel_tol=1e-6) and lam > 0
    assert math.isclose(k, 46 / ((rest + 61) * math.exp(-2 * lam)), rel_tol=1e-6)


def corpus(n, rng, words):
    return [" ".join(rng.choices(words, k=60)) for _ in range(n)]


def test_copies_are_evidence_once(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(4000)]
    rows = [(i, t, 0) for i, t in enumerate(corpus(400, rng, words))]
    copied = corpus(1, rng, [w[::-1] + "q" for w in words])[0]  # rare words, in one toxic text only, copied 60 times
    rows += [(1000 + i, copied, 1) for i in range(60)]
    for i, t in enumerate(corpus(60, rng, words)):
        w = t.split()
        w[rng.randrange(60)] = w[rng.randrange(60)] = "vileword"
        rows.append((2000 + i, " ".join(w), 1))
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    lexicon = toxicity.fit(table, labels)
    assert set(keyed(["vileword"])) <= set(lexicon.key)
    assert not set(keyed(copied.split())) & set(lexicon.key)
    scored = toxicity.score(table, lexicon, ["doc_id"]).select("doc_id", "toxicity.predicted").collect()
    assert np.mean([r.predicted for r in scored if r.doc_id >= 2000]) > 0.9
    assert np.mean([r.predicted for r in scored if r.doc_id < 1000]) < 0.01


def test_the_sample_is_bounded(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(2, "the same")] * 3000 + [(i, f"other {i}") for i in range(3, 40)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(2, 0)] * 500 + [(2, 1), (None, 1), (3, None)],
                                   "doc_id long, toxic int")
    got = [tuple(r) for r in labelled_texts(table, labels, "toxic", 3, 7, 100).collect()]
    assert len(got) == 100
    everything = labelled_texts(table, labels, "toxic", 3, 7, 100_000).collect()
    assert len(everything) == 3000 + 2 + 37  # repeated rows count once for each label
    assert set(got) <= {tuple(r) for r in everything}
    model = quality.fit(table, labels.withColumnRenamed("toxic", "quality"), max_rows=50)
    assert quality.score(table, model, ["doc_id"]).count() == len(rows)
