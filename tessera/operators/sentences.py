"""F8: sentences, from boundary statistics that the corpus itself gives.

A full stop ends a sentence, marks an abbreviation, or both.  Which it is
follows from counts over the whole corpus, by the published log-likelihood
criteria for unsupervised sentence boundaries:

* a word is an **abbreviation** if it stands before a stop far more often than
  words do (short words and words with inner stops more readily, words also
  seen without a stop less);
* a word is a **sentence starter** if it follows a sure end far more often
  than it occurs;
* two words are a **collocation** if the second follows the first's stop far
  more often than by chance.

The statistics are Spark aggregations of one row a word; what they find is a
small table ``(kind, w, w2)``.  Deciding is native, too: only words with a stop
are looked up, by joins on that table, and their document's text is cut at the
places found.  No text is tokenised in Python.

Sentences run from one boundary to the next; line breaks are blanks.  A null
or blank text has no sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE, strip_outer_punct

# Thresholds of the published method.
ABBREVIATION = 0.3
COLLOCATION = 7.88
STARTER = 30.0
# Closing quotes and brackets after the mark that ends a sentence.
CLOSERS = r"[\"')\]}»”’]+$"
#: A piece that may end a sentence; all of ``kind`` 1 and 2 are among them.
MAY_END = r"[.!?][\"')\]}»”’]*$"
UPPER = r"^[^\p{L}]*\p{Lu}"
LEAST_PAIRS = 2
_TINY = 1e-12


def _cut(text_col: str) -> Column:
    """The white-space-delimited pieces of a text."""
    return F.array_remove(F.split(F.col(text_col), f"{WHITESPACE}+"), "")


def _with_next(p: Column) -> Column:
    """``array<struct<x, nx>>``: every piece and the one after it."""
    return F.arrays_zip(p.alias("x"), F.slice(p, F.lit(2), F.size(p)).alias("nx"))


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, pos, x, nx)``: every piece as it stands and the one after it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _cut(text_col).alias("p"))
    return rows.select("doc_id", F.posexplode(_with_next(F.col("p"))).alias("pos", "s")).select("doc_id", "pos", "s.x", "s.nx")


def _core(x: Column) -> Column:
    return F.regexp_replace(x, CLOSERS, "")


def _kind(x: Column) -> Column:
    core = _core(x)
    return F.when(core.rlike(r"[!?]$"), 2).when(core.endswith("."), 1).otherwise(0)


def _word(x: Column) -> Column:
    return strip_outer_punct(F.lower(_core(x)))


def _described(rows: DataFrame) -> DataFrame:
    x, nx = F.col("x"), F.col("nx")
    return rows.select("doc_id", "pos", _kind(x).alias("kind"), _word(x).alias("word"), x.rlike(UPPER).alias("upper"),
                       _word(nx).alias("next_word"), nx.rlike(UPPER).alias("next_upper"), nx.isNull().alias("last"))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, pos, kind, word, upper, next_word, next_upper, last)``: every
    white-space-delimited piece and what follows it.

    ``kind`` is 2 if it ends in ``!`` or ``?``, 1 in a full stop, else 0, closing
    quotes aside; ``word`` is lower-case, without outer punctuation.
    """
    return _described(_placed(docs, id_col, text_col))


def tally(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(kind, word, next_word, stopped, n)``: how often each word stands in the
    texts with each mark, and before which word if it has one (``stopped``).

    Occurrences are counted as they stand, map-side combined; only distinct
    pieces, and distinct pairs around a mark, are described.
    """
    rows = docs.select(_cut(text_col).alias("p")).select(F.inline(_with_next(F.col("p"))).alias("x", "nx"))
    nx = F.when(F.col("x").rlike(MAY_END), F.col("nx"))
    counted = rows.select("x", nx.alias("nx")).groupBy("x", "nx").agg(F.count(F.lit(1)).alias("n"))
    x, nx = F.col("x"), F.col("nx")
    known = counted.select(_kind(x).alias("kind"), _word(x).alias("word"), "nx", "n")
    stopped = (F.col("kind") > 0) & nx.isNotNull()
    known = known.select("kind", "word", F.when(stopped, _word(nx)).alias("next_word"), stopped.alias("stopped"), "n")
    return known.groupBy("kind", "word", "next_word", "stopped").agg(F.sum("n").alias("n"))


def tally_of_pieces(rows: DataFrame) -> DataFrame:
    """:func:`tally` of :func:`pieces`."""
    stopped = (F.col("kind") > 0) & ~F.col("last")
    return rows.select("kind", "word", F.when(stopped, F.col("next_word")).alias("next_word"), stopped.alias("stopped")) \
        .groupBy("kind", "word", "next_word", "stopped").agg(F.count(F.lit(1)).alias("n"))


def _log(x: Column) -> Column:
    return F.log(F.greatest(x, F.lit(_TINY)))


def abbreviation_score(n: Column, k: Column, word: Column, pieces_: Column, stops: Column) -> Column:
    """How much rather a word seen ``n`` times, ``k`` of them before a stop, is an abbreviation."""
    share = stops / pieces_
    chance = k * _log(share) + (n - k) * _log(1 - share)
    always = k * F.log(F.lit(0.99)) + (n - k) * F.log(F.lit(0.01))
    letters = F.length(F.replace(word, F.lit("."), F.lit(""))).cast("double")
    inner = F.length(word) - letters + 1
    return -2 * (chance - always) * F.exp(-letters) * inner * F.pow(letters, -(n - k).cast("double"))


def pair_score(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Log-likelihood ratio of ``b`` after ``a``: they came ``a``, ``b`` and together ``ab`` times in ``n``."""
    p, p1, p2 = b / n, ab / a, (b - ab) / F.greatest(n - a, F.lit(1))
    one = ab * _log(p) + (a - ab) * _log(1 - p)
    two = (b - ab) * _log(p) + (n - a - b + ab) * _log(1 - p)
    three = F.when(a == ab, 0.0).otherwise(ab * _log(p1) + (a - ab) * _log(1 - p1))
    four = F.when(b == ab, 0.0).otherwise((b - ab) * _log(p2) + (n - a - b + ab) * _log(1 - p2))
    return -2 * (one + two - three - four)


def has_letter(w: Column) -> Column:
    return w.rlike(r"\p{L}")


def is_bare(w: Column) -> Column:
    """A number or an initial: its stop says as little as an abbreviation's."""
    return w.rlike(r"^[0-9]+$") | w.rlike(r"^\p{L}$")


def parameters(rows: DataFrame) -> DataFrame:
    """:func:`found` from the pieces."""
    return found(tally_of_pieces(rows))


def found(seen: DataFrame) -> DataFrame:
    """``(kind, w, w2)`` from a :func:`tally`: ``abbr`` and ``starter`` words, ``pair``
    collocations.  The tally is read several times: a written table."""
    words = seen.where("word <> ''")
    occurrences, stops_ = F.sum("n").cast("double"), F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0)).cast("double")
    counts = words.groupBy("word").agg(occurrences.alias("n"), stops_.alias("k"))
    total = words.agg(occurrences.alias("pieces"), stops_.alias("stops"))
    n = total.agg(F.max("pieces")).scalar()
    stops = total.agg(F.max("stops")).scalar()
    abbr = counts.where((F.col("k") > 0) & has_letter(F.col("word")) & ~is_bare(F.col("word"))).where(
        abbreviation_score(F.col("n"), F.col("k"), F.col("word"), n, stops) >= ABBREVIATION).select("word")

    stopped = seen.where("stopped")
    known = stopped.join(abbr.withColumn("abbr", F.lit(True)), "word", "left").withColumn(
        "weak", (F.col("kind") == 1) & (F.coalesce("abbr", F.lit(False)) | is_bare(F.col("word"))))
    # words after a sure end
    sure = known.where("NOT weak")
    ends = sure.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).scalar()
    after = sure.where(has_letter(F.col("next_word"))).groupBy(F.col("next_word").alias("word")).agg(
        F.sum("n").cast("double").alias("ab")).join(counts, "word")
    starter = after.where((F.col("ab") * n > F.col("n") * ends)
                          & (pair_score(ends, F.col("n"), F.col("ab"), n) >= STARTER)).select("word")
    # words after the stop of an abbreviation, a number or an initial
    pairs = known.where(F.col("weak") & has_letter(F.col("next_word"))).groupBy("word", "next_word").agg(
        F.sum("n").cast("double").alias("ab")).where(F.col("ab") >= LEAST_PAIRS)
    pairs = (pairs.join(counts.select("word", F.col("n").alias("a")), "word")
             .join(counts.select(F.col("word").alias("next_word"), F.col("n").alias("b")), "next_word"))
    pair = pairs.where((F.col("ab") * n > F.col("a") * F.col("b"))
                       & (pair_score(F.col("a"), F.col("b"), F.col("ab"), n) >= COLLOCATION)).select("word", "next_word")
    none = F.lit(None).cast("string").alias("w2")
    return (abbr.select(F.lit("abbr").alias("kind"), F.col("word").alias("w"), none)
            .unionByName(starter.select(F.lit("starter").alias("kind"), F.col("word").alias("w"), none))
            .unionByName(pair.select(F.lit("pair").alias("kind"), F.col("word").alias("w"), F.col("next_word").alias("w2"))))


def boundaries(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``(doc_id, pos)`` of the pieces that end a sentence, a document's last one aside."""
    def of(kind: str, w: str, flag: str) -> DataFrame:
        return params.where(F.col("kind") == kind).select(F.col("w").alias(w), F.lit(True).alias(flag))

    x = rows.where("kind > 0 AND NOT last")
    x = x.join(of("abbr", "word", "abbr"), "word", "left").join(of("starter", "next_word", "starter"), "next_word", "left")
    pair = params.where("kind = 'pair'").select(F.col("w").alias("word"), F.col("w2").alias("next_word"), F.lit(True).alias("pair"))
    x = x.join(pair, ["word", "next_word"], "left")
    weak = F.coalesce("abbr", F.lit(False)) | is_bare(F.col("word"))
    ends = (F.when(F.col("kind") == 2, True)
            .when(F.col("word") == "", F.col("next_upper"))  # dots only
            .when(weak & F.coalesce("pair", F.lit(False)), False)
            .when(weak, F.coalesce("starter", F.lit(False)) & F.col("next_upper"))
            .otherwise(True))
    return x.where(ends).select("doc_id", "pos")


def sentences(docs: DataFrame, params: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sentence, first_pos, n_pieces, text)``, numbered from 0;
    ``text`` has single blanks between the pieces."""
    ends = _placed(docs, id_col, text_col).where(F.col("x").rlike(MAY_END) & F.col("nx").isNotNull())
    at = boundaries(_described(ends), params).groupBy("doc_id").agg(F.array_sort(F.collect_list("pos")).alias("ends"))
    # texts are cut after the join: it takes them, not their pieces
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).join(at, "doc_id", "left").select(
        "doc_id", _cut("_text").alias("p"), F.coalesce("ends", F.array().cast("array<int>")).alias("ends"))
    stops = F.concat("ends", F.array(F.size("p") - 1))
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e + 1))
    spans = F.arrays_zip(starts.alias("first"), stops.alias("stop"))
    rows = whole.select("doc_id", "p", F.posexplode(spans).alias("sentence", "s")).where(F.col("s.stop") >= 0)
    return rows.select("doc_id", "sentence", F.col("s.first").alias("first_pos"), (F.col("s.stop") - F.col("s.first") + 1).alias("n_pieces"),
                       F.array_join(F.slice("p", F.col("s.first") + 1, F.col("s.stop") - F.col("s.first") + 1), " ").alias("text"))
