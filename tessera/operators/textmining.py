"""Tokens, noun lemmas, stop words, term and document frequencies, IDF and
TF-IDF in coordinate form (F8-F11, P4, P11-P13, A4-A6, A9, W5, T1, M1, M2, M5).

Tables are long: ``(doc_id, pos, token)``, ``(doc_id, term, cnt)``,
``(term, df)``, ``(term_id, term, df, idf)``, ``(doc_id, term_id, w)``.
Counting is done with map-side-combined aggregations, so a term that occurs
in every document (a hot key) is summed per task before any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lemma_candidates, raw_pieces, word_of

NUM_TERMS = 5000
MIN_LEXICON_DF = 2


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """F8 + P11: ``(doc_id, pos, token)``.

    Lower-case; clitics split off; cut on white space; characters that are
    neither letter nor digit stripped from both ends; kept when letters only
    and longer than 2.  ``pos`` is the piece's 0-based place in the text.
    A null text gives no rows (F10).
    """
    words = F.transform(raw_pieces(text_col),
                        lambda piece, i: F.struct(i.alias("pos"), word_of(piece).alias("token")))
    kept = F.filter(words, lambda w: w["token"] != "")
    return spread(docs).select(F.col(id_col).alias("doc_id"), F.inline(kept))


def counts_by_row(docs: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A4 of rows that are a document each: ``(doc_id, term, cnt)`` plus the
    ``keep`` columns.  A row's tokens are sorted and their runs counted where
    the row lies: no shuffle, and no task holds more than a row's tokens."""
    words = F.sort_array(F.filter(F.transform(raw_pieces(text_col), word_of), lambda w: w != ""))
    rows = spread(docs).select(F.col(id_col).alias("doc_id"), *keep, words.alias("_w"))
    # no filter on the words: pushed below, it would cut the texts once more
    places = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1))
    rows = rows.select("doc_id", *keep, "_w", F.filter(
        places, lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1))).alias("_first"))
    runs = F.transform("_first", lambda at, k: F.struct(
        F.get("_w", at).alias("term"),
        (F.coalesce(F.get("_first", k + 1), F.size("_w")) - at).cast("bigint").alias("cnt")))
    return rows.select("doc_id", F.inline(runs), *keep)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cores when its scan has fewer partitions
    than the default parallelism (a small file with few row groups); large
    inputs already have more splits than cores and are left as they are."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # a session without RDD access (Spark Connect): leave as is
        return df
    return df.repartition(cores) if parts < cores else df


def frequent_terms(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` most frequent terms ``(token, cnt)`` of a count table
    ``(doc_id, term, cnt)`` (ties by term)."""
    totals = counts.groupBy(F.col("term").alias("token")).agg(F.sum("cnt").alias("cnt"))
    return totals.orderBy(F.desc("cnt"), "token").limit(top)


def token_counts(tokens: DataFrame, term_col: str = "token") -> DataFrame:
    """A4 on any token table: ``(doc_id, term, cnt)``."""
    return tokens.groupBy("doc_id", F.col(term_col).alias("term")).agg(
        F.count(F.lit(1)).alias("cnt"))


def document_frequency(term_freq: DataFrame) -> DataFrame:
    """``(term, df)`` from ``(doc_id, term, cnt)`` (one row per doc and term)."""
    return term_freq.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _shortest_accepted(accepted: DataFrame) -> DataFrame:
    """``(term, lemma)``: per term, the shortest accepted candidate (ties by rule)."""
    return accepted.groupBy("term").agg(
        F.min_by("cand", F.struct(F.length("cand"), F.col("rule"))).alias("lemma"))


def lemma_table(terms: DataFrame, lexicon: DataFrame,
                exceptions: DataFrame | None = None) -> DataFrame:
    """``(term, lemma)`` for every distinct ``term``.

    Candidates are the term itself and the forms one noun-detachment rule
    gives; a candidate counts when it is in ``lexicon`` (column ``term``);
    the shortest accepted candidate wins (ties: the term itself, then rule
    order); with none accepted the term is its own lemma.  A term listed in
    ``exceptions`` ``(word, lemma)`` gets no rule candidates: itself (if in
    the lexicon) and its listed lemmas, which are accepted as they are.
    Work is per distinct term, never per occurrence.
    """
    t = terms.select("term").distinct()
    return t.join(_shortest_accepted(_accepted(t, lexicon, exceptions)), "term", "left").select(
        "term", F.coalesce(F.col("lemma"), F.col("term")).alias("lemma"))


def _accepted(t: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None) -> DataFrame:
    """``(term, cand, rule)``: the accepted candidates of distinct terms ``t``."""
    lex = lexicon.select(F.col("term").alias("cand")).distinct()
    if exceptions is not None:
        exc = exceptions.select(F.col("word").alias("term"), F.col("lemma").alias("cand"))
        t_rules = t.join(exc.select("term").distinct(), "term", "left_anti")
        t_exc = t.join(exc.select("term").distinct(), "term", "left_semi")
    else:
        t_rules = t
    accepted = t_rules.select("term", F.inline(lemma_candidates("term"))).join(lex, "cand", "left_semi")
    if exceptions is not None:
        self_ok = t_exc.select("term", F.col("term").alias("cand"), F.lit(0).alias("rule")) \
            .join(lex, "cand", "left_semi")
        listed = exc.join(t_exc, "term", "left_semi").select("term", "cand", F.lit(1).alias("rule"))
        accepted = accepted.unionByName(self_ok).unionByName(listed)
    return accepted


def lemma_changes(terms: DataFrame, lexicon: DataFrame,
                  exceptions: DataFrame | None = None) -> DataFrame:
    """``(term, lemma)`` of the terms whose lemma differs from the term (the
    only rows :func:`with_lemma` needs), without the join back to all terms."""
    accepted = _accepted(terms.select("term").distinct(), lexicon, exceptions)
    return _shortest_accepted(accepted).where(F.col("lemma") != F.col("term"))


def corpus_lexicon(tokens: DataFrame, min_df: int = MIN_LEXICON_DF) -> DataFrame:
    """The corpus's own lexicon: tokens found in at least ``min_df`` documents ``(term)``."""
    df = document_frequency(token_counts(tokens))
    return df.where(F.col("df") >= min_df).select("term")


def with_lemma(rows: DataFrame, lemmas: DataFrame, token_col: str = "token", by_rule: bool = False) -> DataFrame:
    """Add ``lemma`` to rows holding a token.

    Only terms whose lemma differs from the term are looked up (a small
    share of all terms); while that table is under Spark's broadcast
    threshold, the token rows are not shuffled for this step.  ``by_rule``
    says that every lemma in it came from a detachment rule: rows whose token
    has none of the rules' suffixes are then left out of the join.
    """
    if by_rule:
        can_change = F.size(lemma_candidates(token_col)) > 1
        same = rows.where(~F.coalesce(can_change, F.lit(False))).withColumn("lemma", F.col(token_col))
        return with_lemma(rows.where(can_change), lemmas, token_col).unionByName(same)
    changes = lemmas.where(F.col("term") != F.col("lemma")).select(
        F.col("term").alias("_t"), F.col("lemma").alias("_l"))
    j = rows.join(changes, F.col(token_col) == F.col("_t"), "left")
    return j.withColumn("lemma", F.coalesce(F.col("_l"), F.col(token_col))).drop("_t", "_l")


def lemmatize_tokens(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(doc_id, pos, token, lemma)``, lemma longer than 2."""
    j = with_lemma(tokens, lemmas)
    return j.select("doc_id", "pos", "token", "lemma").where(F.length("lemma") > 2)


def drop_stopwords(rows: DataFrame, stopwords: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is not a stop word (column ``word``)."""
    stop = stopwords.select(F.col("word").alias("_w")).distinct()
    return rows.join(stop, rows[col] == stop["_w"], "left_anti")


def term_frequencies(tokens: DataFrame, lemmas: DataFrame, stopwords: DataFrame) -> DataFrame:
    """A4: ``(doc_id, term, cnt)`` of lemmas that are longer than 2 and not stop words.

    Raw tokens are counted per document first (map-side combined), then the
    much smaller count table is mapped to lemmas and summed again.
    """
    return term_frequencies_from_counts(token_counts(tokens), lemmas, stopwords)


def term_frequencies_from_counts(raw_counts: DataFrame, lemmas: DataFrame,
                                 stopwords: DataFrame, with_lengths: bool = False,
                                 by_rule: bool = False) -> DataFrame:
    """:func:`term_frequencies` from raw token counts ``(doc_id, term, cnt)``;
    ``lemmas`` may be the full lemma table or only the changed terms
    (``by_rule``: see :func:`with_lemma`).

    With ``with_lengths`` the rows also carry ``n_terms`` (A5, the TF
    denominator): rows are hash-partitioned by document once, and both the
    per-(document, term) sum and the per-document sum run on that
    partitioning, so TF-IDF later needs no join with a length table.
    """
    raw = raw_counts.withColumnRenamed("term", "token")
    mapped = with_lemma(raw, lemmas, by_rule=by_rule).where(F.length("lemma") > 2)
    mapped = drop_stopwords(mapped, stopwords, "lemma")
    if with_lengths:
        mapped = mapped.repartition("doc_id")
    tf = mapped.groupBy("doc_id", F.col("lemma").alias("term")).agg(
        F.sum("cnt").cast("bigint").alias("cnt"))
    if with_lengths:
        tf = tf.withColumn("n_terms", F.sum("cnt").over(Window.partitionBy("doc_id")).cast("bigint"))
    return tf


def doc_lengths(term_freq: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """A5: ``(doc_id, n_terms)``, all kept terms of a document (also those
    outside the vocabulary); with ``docs``, documents without terms get 0."""
    lengths = term_freq.groupBy("doc_id").agg(F.sum("cnt").cast("bigint").alias("n_terms"))
    if docs is None:
        return lengths
    return docs.select("doc_id").join(lengths, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("n_terms"), F.lit(0).cast("bigint")).alias("n_terms"))


def vocabulary(doc_freq: DataFrame, num_terms: int = NUM_TERMS) -> DataFrame:
    """W5 + T1: ``(term_id, term, df)``, the ``num_terms`` terms in most
    documents (ties by term), ids 0.. in that order.

    The limit is a two-phase top-k; the id window runs over at most
    ``num_terms`` rows.
    """
    order = [F.desc("df"), F.col("term")]
    top = doc_freq.orderBy(*order).limit(num_terms)
    return top.select(
        (F.row_number().over(Window.orderBy(*order)) - 1).cast("int").alias("term_id"),
        "term", "df")


def idf_table(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    """M1 + A9: ``(term_id, term, df, idf)`` with ``idf = ln(N / df)`` (not
    smoothed); ``N`` counts all documents, also those without terms.  ``N``
    is a scalar subquery, so the plan stays lazy."""
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    return vocab.select("term_id", "term", "df",
                        F.ln(n_docs / F.col("df").cast("double")).alias("idf"))


def tfidf_coo(term_freq: DataFrame, lengths: DataFrame | None, idf: DataFrame) -> DataFrame:
    """M2: ``(doc_id, term_id, w)`` with ``w = idf * cnt / n_terms``.

    The IDF table has at most ``num_terms`` rows, so it is broadcast.
    ``n_terms`` comes from ``term_freq`` when it carries it (then the plan is
    map-only), else from a join with ``lengths``.
    """
    j = term_freq.join(F.broadcast(idf.select("term", "term_id", "idf")), "term")
    if "n_terms" not in term_freq.columns:
        j = j.join(lengths, "doc_id")
    return j.select("doc_id", "term_id",
                    (F.col("idf") * F.col("cnt") / F.col("n_terms")).alias("w"))


def query_vector(queries: DataFrame, idf: DataFrame) -> DataFrame:
    """M5: ``(query_id, term_id, w)``: the IDF of each known query word,
    summed when a word repeats; unknown words are dropped."""
    j = queries.join(F.broadcast(idf.select("term", "term_id", "idf")), "term")
    return j.groupBy("query_id", "term_id").agg(F.sum("idf").alias("w"))


def idf_of(n_docs: int, df: int) -> float:
    """Reference formula for one term, for tests."""
    return math.log(n_docs / df)
