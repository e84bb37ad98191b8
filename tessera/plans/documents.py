"""Documents -> tokens -> lemmas -> TF-IDF -> truncated SVD -> concept reports
and keyword search, as DataFrame plans over a data folder (the stand-in
tables) or the reference's own files (``files.PlotFiles``).

Parameters default to the reference's (5,000 terms, 25 concepts, 25 terms
and documents per concept, 5 genres, 10 results per query).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import concepts as C
from ..operators import sentences as S
from ..operators import textmining as T
from ..operators.sampling import hash_sample
from ..sources import delimited, files, staging, tables
from . import store

# The reference's ten three-word queries.
REFERENCE_QUERIES = (
    ("murder", "detective", "suspect"),
    ("love", "romance", "wedding"),
    ("war", "soldier", "battle"),
    ("monster", "creature", "horror"),
    ("space", "alien", "planet"),
    ("heist", "robbery", "gang"),
    ("king", "kingdom", "throne"),
    ("ghost", "haunted", "spirit"),
    ("drug", "dealer", "crime"),
    ("revenge", "betrayal", "enemy"),
)
# A word no tokenizer output can contain (it has a digit).
UNKNOWN_WORD = "zz9unknown"
# Upper bounds of the vocabulary and concept count (see ``Params``).  V has at
# most MAX_CELLS doubles (16 MB); the block SVD's basis, on the driver and in
# every task of a pass, is some 20 times that.
MAX_TERMS = 100_000
MAX_CONCEPTS = 1_000
MAX_CELLS = 2_000_000


@dataclass(frozen=True)
class Params:
    num_terms: int = T.NUM_TERMS
    k: int = C.K
    top_terms: int = 25
    top_docs: int = 25
    genres: int = 5
    results: int = 10
    stop_top: int = 7
    # Share of documents kept (hash sample on the document key); 1.0 keeps all.
    sample_fraction: float = 1.0
    # Singular values below this share of the largest are dropped (Spark's default).
    rcond: float = 1e-9

    def __post_init__(self) -> None:
        # V (num_terms x k doubles) reaches the driver and is sent to the
        # executors: these parameters are its size bound.
        if not 1 <= self.num_terms <= MAX_TERMS:
            raise ValueError(f"num_terms must be in 1..{MAX_TERMS}, got {self.num_terms}")
        if not 1 <= self.k <= min(self.num_terms, MAX_CONCEPTS):
            raise ValueError(f"k must be in 1..min(num_terms, {MAX_CONCEPTS}), got {self.k}")
        if self.num_terms * self.k > MAX_CELLS:
            raise ValueError(f"num_terms x k must be at most {MAX_CELLS}")
        if not 0.0 < self.sample_fraction <= 1.0:
            raise ValueError(f"sample_fraction must be in (0, 1], got {self.sample_fraction}")


Source = str | files.PlotFiles


def docs(spark: SparkSession, d: Source, p: Params = Params(), *more: Column) -> DataFrame:
    """P1 + P3 + P14: ``(doc_id, title, genre, text)``, rows with a null
    dropped, hash-sampled when ``p.sample_fraction < 1``; plus the columns
    ``more`` of a data folder's table.

    ``d`` is a parquet data folder (the ``documents`` table) or the
    reference's plot CSV and stop-word file (:class:`files.PlotFiles`),
    whose rows get ids once, in a stored table."""
    if isinstance(d, files.PlotFiles):
        out = store.stored(spark, "documents", (d,), lambda: files.documents(spark, d))
    else:
        out = tables.documents(spark, d, *more)
    if p.sample_fraction < 1.0:
        out = hash_sample(out, p.sample_fraction, ["doc_id"])
    return out


def doc_meta(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(doc_id, title, genre)`` of :func:`docs`, written once per application:
    counts and lookups read it instead of scanning the texts."""
    return store.stored(spark, "doc_meta", (d, p.sample_fraction),
                        lambda: docs(spark, d, p).select("doc_id", "title", "genre"))


def tokens(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return T.tokenize(docs(spark, d, p))


def sentence_parameters(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """F8: ``(kind, w, w2)``: abbreviations, sentence starters and collocations
    of the documents, written once per application."""
    def build() -> DataFrame:
        # the texts are cut once: what follows reads the distinct words' counts
        return S.found(store.stored(spark, "sentence_tally", (d, p.sample_fraction),
                                    lambda: S.tally(T.spread(docs(spark, d, p)))))
    return store.stored(spark, "sentence_parameters", (d, p.sample_fraction), build)


def doc_sentences(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """F8: ``(doc_id, sentence, first_pos, n_pieces, text)`` of every document."""
    return S.sentences(T.spread(docs(spark, d, p)), sentence_parameters(spark, d, p))


def stopwords(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """The stop-word file: the given one, or for a data folder one derived
    from its English documents and read back."""
    if isinstance(d, files.PlotFiles):
        return files.stopwords(spark, d)
    return delimited.read_stopwords(
        spark, staging.stopword_file(spark, d, bag_of_words(spark, d, p), p.stop_top,
                                     tag=f"-{p.sample_fraction}"))


def repeated_ids(spark: SparkSession, d: Source) -> DataFrame:
    """``(doc_id)`` of the ids that more than one row of the documents has,
    written once per application."""
    whole = docs(spark, d) if isinstance(d, files.PlotFiles) else tables.table(spark, d, "documents")
    return store.stored(spark, "repeated_ids", (d,), lambda: whole.where(F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("doc_id"))


def bag_of_words(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(doc_id, term, cnt, english)``: the bag of words of raw tokens (before
    lemmas and stop words) and whether the id has an English row, written once
    per application: the text is tokenized once.

    A row is counted where it lies; only rows that share their id with others
    meet by id."""
    def build() -> DataFrame:
        given = isinstance(d, files.PlotFiles)
        whole = docs(spark, d, p, *([] if given else [F.coalesce(F.col("lang") == "en", F.lit(False)).alias("english")]))
        if given:  # stop words come from a file
            whole = whole.withColumn("english", F.lit(False))
        repeated = repeated_ids(spark, d)
        if not repeated.count():
            return T.counts_by_row(whole, "english")
        once = T.counts_by_row(whole.join(repeated, "doc_id", "left_anti"), "english")
        more = T.counts_by_row(whole.join(repeated, "doc_id", "left_semi"))
        more = more.groupBy("doc_id", "term").agg(F.sum("cnt").alias("cnt"))
        if given:
            return once.unionByName(more.withColumn("english", F.lit(False)))
        # any row of the id counts, also one dropped for its nulls
        english = tables.table(spark, d, "documents").where(F.col("lang") == "en").join(
            repeated, "doc_id", "left_semi").select("doc_id", F.lit(True).alias("_en")).distinct()
        more = more.join(english, "doc_id", "left").select(
            "doc_id", "term", "cnt", F.coalesce("_en", F.lit(False)).alias("english"))
        return once.unionByName(more)
    return store.stored(spark, "bag_of_words", (d, p.sample_fraction), build)


def raw_counts(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """Bag of words ``(doc_id, term, cnt)`` of raw tokens, as stored by
    :func:`bag_of_words`: every later step (lexicon, lemmas, stop words, TF)
    reads this table."""
    return bag_of_words(spark, d, p).select("doc_id", "term", "cnt")


def _terms_and_lexicon(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct terms and the corpus lexicon (terms in >= 2 documents), both
    from one aggregation of the bag of words."""
    term_df = T.document_frequency(raw)
    return term_df.select("term"), term_df.where(F.col("df") >= T.MIN_LEXICON_DF).select("term")


def _lemma_inputs(spark: SparkSession, d: Source, raw: DataFrame
                  ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Distinct terms, the lexicon (the files' own, else the corpus's) and the
    irregular nouns, if any."""
    terms, lexicon = _terms_and_lexicon(raw)
    if not isinstance(d, files.PlotFiles):
        return terms, lexicon, None
    given = files.lexicon(spark, d)
    return terms, lexicon if given is None else given, files.exceptions(spark, d)


def lemmas(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(term, lemma)`` with the given lexicon and irregular nouns, or the
    corpus lexicon (tokens in >= 2 documents).

    Distinct terms and the lexicon come from one aggregation of the raw
    counts, so the text is tokenized once.
    """
    return T.lemma_table(*_lemma_inputs(spark, d, raw_counts(spark, d, p)))


def lemma_changes(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(term, lemma)`` of the terms whose lemma differs, written once per
    application: of a written table Spark knows the size before it plans a
    join, so that token rows are not shuffled by term while it is small."""
    return store.stored(spark, "lemma_changes", (d, p.sample_fraction),
                        lambda: T.lemma_changes(*_lemma_inputs(spark, d, raw_counts(spark, d, p))))


def lemma_tokens(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return T.lemmatize_tokens(tokens(spark, d, p), lemma_changes(spark, d, p))


def tokens_without_stopwords(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(doc_id, pos, term)``: lemmas that are not stop words."""
    kept = T.drop_stopwords(lemma_tokens(spark, d, p), stopwords(spark, d, p), "lemma")
    return kept.select("doc_id", "pos", F.col("lemma").alias("term"))


def term_table(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(doc_id, term, cnt, n_terms)``, written once per application (shared
    by every later step of the concepts chain)."""
    def build() -> DataFrame:
        raw = raw_counts(spark, d, p)
        # irregular nouns can change any term; rules only those with their suffixes
        by_rule = not isinstance(d, files.PlotFiles) or d.exceptions_path is None
        return T.term_frequencies_from_counts(raw, lemma_changes(spark, d, p), stopwords(spark, d, p),
                                              with_lengths=True, by_rule=by_rule)
    return store.stored(spark, "term_freq", (d, p.stop_top, p.sample_fraction), build)


def term_freq(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """A4: ``(doc_id, term, cnt)``."""
    return term_table(spark, d, p).select("doc_id", "term", "cnt")


def doc_lengths(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return T.doc_lengths(term_freq(spark, d, p), doc_meta(spark, d, p))


def doc_freq(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return T.document_frequency(term_freq(spark, d, p))


def idf(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M1 + W5: ``(term_id, term, df, idf)`` of the vocabulary, stored once
    per application (at most ``num_terms`` rows, read by every later step)."""
    return store.stored(spark, "idf", (d, p), lambda: T.idf_table(
        T.vocabulary(doc_freq(spark, d, p), p.num_terms), doc_meta(spark, d, p)))


def vocabulary(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """W5 + T1: ``(term_id, term, df)``."""
    return idf(spark, d, p).select("term_id", "term", "df")


def tfidf(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M2: ``(doc_id, term_id, w)``: a map-only plan over the stored term
    table (it carries the document lengths) and the broadcast IDF table."""
    return T.tfidf_coo(term_table(spark, d, p), None, idf(spark, d, p))


def doc_metadata_lookup(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """J8 + W4: ``(doc_id, title, genre)`` of every document with a term;
    genre ``unknown`` when the document table has none."""
    ids = term_freq(spark, d, p).select("doc_id").distinct()
    meta = doc_meta(spark, d, p)
    j = ids.join(meta, "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.col("title"), F.col("doc_id").cast("string")).alias("title"),
                    F.coalesce(F.col("genre"), F.lit("unknown")).alias("genre"))


_DECOMPOSITIONS: dict[tuple, C.Decomposition] = {}


def decomposition(spark: SparkSession, d: Source, p: Params = Params()) -> C.Decomposition:
    """M3, computed once per application, data folder and parameters."""
    def make() -> C.Decomposition:
        n_terms = vocabulary(spark, d, p).count()
        return C.truncated_svd(spark, tfidf(spark, d, p), n_terms, p.k, p.rcond)
    return store.once(_DECOMPOSITIONS, ("svd", spark.sparkContext.applicationId, d, p,
                                       store.fingerprint(spark, d)), make)


def svd_singular_values(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M3: ``(concept, s)``."""
    return decomposition(spark, d, p).sigma


def doc_vectors(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M4: ``(doc_id, us)``, the rows of ``U * S``, stored once per application
    (concept reports, scores and keyword search all read them)."""
    return store.stored(spark, "doc_vectors", (d, p), lambda: C.doc_vectors(
        tfidf(spark, d, p), decomposition(spark, d, p), doc_meta(spark, d, p)))


def doc_concept_scores(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M4: ``(doc_id, concept, score)`` of ``U * S``, all documents."""
    return C.doc_concept_scores(doc_vectors(spark, d, p))


def concept_top_terms(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return C.concept_top_terms(decomposition(spark, d, p), vocabulary(spark, d, p), p.top_terms)


def concept_top_docs(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return C.concept_top_docs(doc_vectors(spark, d, p), decomposition(spark, d, p),
                              doc_meta(spark, d, p), p.top_docs)


def concept_genres(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return C.concept_genres(concept_top_docs(spark, d, p), p.genres)


def concept_report_lines(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    return C.concept_report_lines(concept_top_terms(spark, d, p), concept_top_docs(spark, d, p),
                                  p.genres)


def query_words(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """``(query_id, term)``: the reference's ten queries (ids 0-9), ten
    three-word queries from vocabulary ids 0-29 (ids 10-19), and one with a
    repeated known word and an unknown word (id 20)."""
    fixed = spark.createDataFrame(
        [(i, w) for i, ws in enumerate(REFERENCE_QUERIES) for w in ws], "query_id int, term string")
    vocab = vocabulary(spark, d, p)
    derived = vocab.where(F.col("term_id") < 30).select(
        (F.lit(10) + F.floor(F.col("term_id") / 3)).cast("int").alias("query_id"), "term")
    first = vocab.where(F.col("term_id") == 0).select(F.lit(20).alias("query_id"), "term")
    unknown = spark.createDataFrame([(20, UNKNOWN_WORD)], "query_id int, term string")
    return fixed.unionByName(derived).unionByName(first).unionByName(first).unionByName(unknown)


def query_vector(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M5: ``(query_id, term_id, w)``."""
    return T.query_vector(query_words(spark, d, p), idf(spark, d, p))


def query_concepts(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M6: ``(query_id, concept, x)`` of ``V^T q``."""
    qc = C.query_concepts(query_vector(spark, d, p), decomposition(spark, d, p),
                          query_words(spark, d, p))
    return qc.select("query_id", F.posexplode("qc").alias("concept", "x"))


def _query_vectors(spark: SparkSession, d: Source, p: Params) -> DataFrame:
    dec = decomposition(spark, d, p)
    return C.query_concepts(query_vector(spark, d, p), dec, query_words(spark, d, p))


def search_blocks(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """The documents' vectors in blocks with bounds, written once per application."""
    return store.stored(spark, "search_blocks", (d, p),
                        lambda: C.innersearch.blocks(doc_vectors(spark, d, p), "doc_id", "us"))


def keyword_search(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """M7 + M8: top ``results`` documents of every query."""
    return C.keyword_search(doc_vectors(spark, d, p), _query_vectors(spark, d, p), doc_meta(spark, d, p),
                            p.results, search_blocks(spark, d, p))


def keyword_search_work(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """One row ``(scored_pairs, all_pairs)``: how many pairs of a query and a
    document the search scored, and how many there are."""
    return C.keyword_hits(doc_vectors(spark, d, p), _query_vectors(spark, d, p), p.results,
                          search_blocks(spark, d, p)).work


def matrix_shapes(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """One row ``(n_docs, n_terms, n_concepts)``."""
    n_concepts = len(decomposition(spark, d, p).s)
    n_terms = vocabulary(spark, d, p).agg(F.count(F.lit(1))).scalar()
    return doc_meta(spark, d, p).agg(F.count(F.lit(1)).alias("n_docs")).select(
        "n_docs", n_terms.alias("n_terms"), F.lit(n_concepts).cast("bigint").alias("n_concepts"))


def run_report(spark: SparkSession, d: Source, p: Params = Params()) -> DataFrame:
    """The run report ``(section, key, value)``: counts, vocabulary,
    singular values, matrix shapes, one line set per concept and per query."""
    from ..operators import report as RP

    dec = decomposition(spark, d, p)
    dcs, vocab = doc_meta(spark, d, p), vocabulary(spark, d, p)
    svals = ", ".join(f"{v:.4f}" for v in dec.s)
    n_docs = dcs.agg(F.count(F.lit(1))).scalar()
    n_terms = vocab.agg(F.count(F.lit(1))).scalar()
    lines = concept_report_lines(spark, d, p)
    hits = keyword_search(spark, d, p)
    parts = [
        RP.timestamp_entry(spark),
        spark.range(1).select(*RP.entry("run", "num_terms", F.lit(p.num_terms))),
        spark.range(1).select(*RP.entry("run", "k", F.lit(p.k))),
        spark.range(1).select(*RP.entry("run", "sample", F.lit(f"{p.sample_fraction * 100:.0f}%"))),
        spark.range(1).select(*RP.entry("run", "spark_version", F.lit(spark.version))),
        RP.scalar_entry(doc_meta(spark, d, replace(p, sample_fraction=1.0)), "dataframe",
                        "total_rows", F.count(F.lit(1))),
        RP.scalar_entry(dcs, "dataframe", "sampled_docs", F.count(F.lit(1))),
        RP.scalar_entry(stopwords(spark, d, p), "dataframe", "stopwords", F.count(F.lit(1))),
        RP.scalar_entry(vocab, "idf", "vocabulary_size", F.count(F.lit(1))),
        RP.scalar_entry(vocab.where(F.col("term_id") < 5), "idf", "first_terms",
                        RP.joined_list("term_id", F.col("term"))),
        spark.range(1).select(*RP.entry("svd", "singular_values", F.lit(svals))),
        spark.range(1).select(*RP.entry(
            "svd", "matrix_shape",
            F.format_string("%d docs x %d terms", n_docs, n_terms))),
        spark.range(1).select(*RP.entry(
            "svd", "uxs_shape", F.format_string("%d rows x %d cols", n_docs, F.lit(len(dec.s))))),
        spark.range(1).select(*RP.entry(
            "svd", "v_shape", F.format_string("%d rows x %d cols", n_terms, F.lit(len(dec.s))))),
        lines.select(F.format_string("concept %d", F.col("concept") + 1).alias("section"),
                     F.expr("stack(3, 'terms', terms, 'docs', docs, 'genres', genres) AS (key, value)")),
        query_words(spark, d, p).groupBy("query_id").agg(
            RP.joined_list("term", F.col("term")).alias("value")).select(
            F.format_string("query %d", "query_id").alias("section"), F.lit("words").alias("key"), "value"),
        hits.select(F.format_string("query %d", "query_id").alias("section"),
                    F.format_string("result %02d", "rank").alias("key"),
                    F.format_string("score=%.6f  title='%s'  genre='%s'", "score", "title", "genre")
                    .alias("value")),
    ]
    return RP.union_all(parts)


def write_run_report(spark: SparkSession, d: Source, p: Params = Params()) -> str:
    """Write the run report as a table under the shared folder; returns its path."""
    from ..operators import report as RP
    from ..session import shared_path

    path = shared_path(spark, "run-report")
    RP.write_report(run_report(spark, d, p), path)
    return path
