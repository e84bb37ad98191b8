"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams
(lengths 1 to 3, within words padded by blanks) in rank order.  A document's
own list is compared to every profile by the out-of-place distance: the sum
over its n-grams of the difference of ranks, or the profile length where the
profile lacks the n-gram.  The nearest profile names the language.

Prediction is one pass without a shuffle; the profiles are at most
``max_languages x size`` short rows.

Defined results: null texts and texts without a letter are ``und`` with score
0; n-grams of equal count are ranked by code; languages at
equal distance by name; repeated rows get equal results; an empty table gives
an empty result.  Without any training row every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from . import textbatch as tb
from .shipping import ship

_LETTER: list[np.ndarray] = []
_BLANK = 1


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(text: str | None) -> np.ndarray:
    """Sorted n-gram codes of a text: up to three code points of 21 bits each.

    Lower-cased; each run of other characters than letters is one blank.
    N-grams never span a blank, blanks (code 1, no letter) may lead or end
    them, so every n-gram has a code of its own.
    """
    if not text:
        return np.zeros(0, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    code = np.concatenate([[_BLANK], np.where(letter, code, _BLANK), [_BLANK]])
    code = code[np.concatenate([[True], (code[1:] != _BLANK) | (code[:-1] != _BLANK)])]
    one = code[code != _BLANK]
    two = code[:-1] << 21 | code[1:]
    three = (code[:-2] << 42 | code[1:-1] << 21 | code[2:])[code[1:-1] != _BLANK]
    return np.sort(np.concatenate([one, two, three]))


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties in code order."""
    if not len(codes):
        return codes
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    count = np.diff(np.append(first, len(codes)))
    return codes[first[np.argsort(-count, kind="stable")[:size]]]


@dataclass(frozen=True)
class Profiles:
    """Sorted n-gram codes of all profiles and their rank in each language
    (``size`` where a profile lacks one)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.  The score is one minus the
        distance to the nearest profile as a share of the largest possible."""
        n_lang = len(self.languages)
        lists = [ranked(grams(t), self.size) for t in texts]
        length = np.array([len(x) for x in lists], np.int64)
        if not n_lang or not length.sum():
            return ["und"] * len(texts), np.zeros(len(texts))
        flat = np.concatenate(lists)
        own = np.concatenate([np.arange(n) for n in length])
        doc = np.repeat(np.arange(len(texts)), length)
        at = np.minimum(np.searchsorted(self.codes, flat), len(self.codes) - 1)
        known = self.codes[at] == flat
        far = np.zeros((len(texts), n_lang))
        for k in range(n_lang):
            rank = self.ranks[at, k]
            step = np.where(known & (rank < self.size), np.abs(rank - own), self.size)
            far[:, k] = np.bincount(doc, step, len(texts))
        best = far.argmin(1)
        worst = np.maximum(length, 1) * self.size
        score = np.where(length > 0, 1 - far[np.arange(len(texts)), best] / worst, 0.0)
        return [self.languages[b] if n else "und" for b, n in zip(best, length, strict=True)], score


def fit(docs: DataFrame, training: Column, lang: str = "lang", text: str = "text", doc_id: str = "doc_id",
        size: int = 300, docs_per_language: int = 1_500, max_languages: int = 1_000) -> Profiles:
    """Profiles from about ``docs_per_language`` training documents of each of
    the ``max_languages`` most frequent languages.

    Documents per language are counted over the whole table; the sample takes
    those whose id hash is below the share that gives the wanted number.
    N-grams are counted by a Spark aggregation; the driver gets the profiles.
    """
    ship(docs.sparkSession)
    rows = docs.where(training & docs[lang].isNotNull() & docs[text].isNotNull())
    counted = (rows.groupBy(rows[lang].cast("string").alias("lang")).count()
               .orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    if not counted:
        return Profiles((), np.zeros(0, np.int64), np.zeros((0, 0), np.int64), size)
    steps = 1 << 20
    share = {r["lang"]: -(-steps * docs_per_language // r["count"]) for r in counted}
    limits = F.create_map(*[F.lit(v) for pair in share.items() for v in pair])
    picked = rows.select(rows[lang].cast("string").alias("lang"), rows[text].alias("text"),
                         F.pmod(F.xxhash64(rows[doc_id]), F.lit(steps)).alias("draw"))
    picked = picked.where(F.col("draw") < limits[F.col("lang")]).select("lang", "text")
    spec = StructType([StructField("lang", StringType()), StructField("code", LongType()), StructField("n", LongType())])

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            codes = [grams(t) for t in batch.column("text").to_pylist()]
            for name in sorted(set(langs)):
                uniq, n = np.unique(np.concatenate([c for c, x in zip(codes, langs, strict=True) if x == name]),
                                    return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(uniq), pa.string()), pa.array(uniq), pa.array(n.astype(np.int64))],
                    names=["lang", "code", "n"])

    total = picked.mapInArrow(count, spec).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = (total.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
            .select("lang", "code", "rank").collect())
    languages = tuple(sorted({r.lang for r in best}))
    codes = np.array(sorted({r.code for r in best}), np.int64)
    ranks = np.full((len(codes), len(languages)), size, np.int64)
    for r in best:
        ranks[np.searchsorted(codes, r.code), languages.index(r.lang)] = r.rank
    return Profiles(languages, codes, ranks, size)


RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def predict(docs: DataFrame, profiles: Profiles, keep: list[str], text: str = "text",
            out: str = "language") -> DataFrame:
    """``docs[keep]`` and a struct ``out`` of ``lang_pred`` and ``score``."""

    def work():
        def apply(texts: pa.Array) -> list[pa.Array]:
            names: list[str] = []
            scores = []
            for at in range(0, len(texts), 512):
                got, s = profiles.predict(texts.slice(at, 512).to_pylist())
                names += got
                scores.append(s)
            return [pa.array(names, pa.string()), pa.array(np.concatenate(scores))]
        return apply

    return tb.annotate(docs, text, keep, out, RESULT, work)
