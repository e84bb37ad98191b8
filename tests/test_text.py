"""F8-F10 tokens, F9 lemmas, M1 IDF, P12 stop words, A4-A6 counts."""

import math

from pyspark.sql import functions as F

from tessera.operators import textmining as T


def _tokens(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [(r.doc_id, r.token) for r in T.tokenize(docs).orderBy("doc_id", "pos").collect()]


def test_tokens_rules(spark):
    got = _tokens(spark, ["Don't stop, John's well-known U.S. naïve 42nd friend!", "", None,
                          "  The  CAT\tsat\nthere  "])
    assert got == [(0, "stop"), (0, "john"), (0, "naïve"), (0, "friend"),
                   (3, "the"), (3, "cat"), (3, "sat"), (3, "there")]


def test_clitic_split_keeps_stem(spark):
    assert _tokens(spark, ["wouldn't they've"]) == [(0, "would"), (0, "they")]


def test_lemma_table_with_lexicon(spark):
    lexicon = spark.createDataFrame(
        [(w,) for w in ["movie", "wolf", "box", "woman", "glass", "glas", "cat", "dog", "tree", "house"]],
        "term string")
    terms = spark.createDataFrame([(w,) for w in ["movies", "wolves", "boxes", "women", "glass", "trees",
                                                  "unknowns"]], "term string")
    got = {r.term: r.lemma for r in T.lemma_table(terms, lexicon).collect()}
    assert got == {"movies": "movie", "wolves": "wolf", "boxes": "box", "women": "woman",
                   "glass": "glas", "trees": "tree", "unknowns": "unknowns"}


def test_lemma_exceptions(spark):
    lexicon = spark.createDataFrame([("mouse",), ("mice",)], "term string")
    exc = spark.createDataFrame([("mice", "mouse")], "word string, lemma string")
    terms = spark.createDataFrame([("mice",), ("mouses",)], "term string")
    got = {r.term: r.lemma for r in T.lemma_table(terms, lexicon, exc).collect()}
    assert got == {"mice": "mice", "mouses": "mouse"}


def test_idf_unsmoothed(spark):
    docs = spark.createDataFrame([(0, "apple pear"), (1, "apple"), (2, "apple")], "doc_id bigint, text string")
    tok = T.tokenize(docs)
    lem = T.lemma_table(tok.select(F.col("token").alias("term")), T.corpus_lexicon(tok))
    stop = spark.createDataFrame([("the",)], "word string")
    tf = T.term_frequencies(tok, lem, stop)
    idf = {r.term: r.idf for r in T.idf_table(T.vocabulary(T.document_frequency(tf), 10), docs).collect()}
    assert idf["apple"] == 0.0
    assert math.isclose(idf["pear"], math.log(3))


def test_stopwords_and_lengths(spark):
    docs = spark.createDataFrame([(0, "the cats and the dogs"), (1, "the the"), (2, "")],
                                 "doc_id bigint, text string")
    tok = T.tokenize(docs)
    lem = T.lemma_table(tok.select(F.col("token").alias("term")),
                        spark.createDataFrame([("cat",), ("dog",)], "term string"))
    stop = spark.createDataFrame([("the",), ("and",)], "word string")
    tf = T.term_frequencies(tok, lem, stop)
    assert sorted((r.doc_id, r.term, r.cnt) for r in tf.collect()) == [(0, "cat", 1), (0, "dog", 1)]
    lengths = {r.doc_id: r.n_terms for r in T.doc_lengths(tf, docs).collect()}
    assert lengths == {0: 2, 1: 0, 2: 0}


def test_vocabulary_ties_by_term(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "term string, df bigint")
    got = [(r.term_id, r.term) for r in T.vocabulary(df, 3).orderBy("term_id").collect()]
    assert got == [(0, "c"), (1, "a"), (2, "b")]


def test_query_vector_repeats_add_unknown_dropped(spark):
    idf = spark.createDataFrame([(0, "war", 1, 2.0), (1, "king", 1, 0.5)],
                                "term_id int, term string, df bigint, idf double")
    q = spark.createDataFrame([(0, "war"), (0, "war"), (0, "zzz"), (1, "nothing")], "query_id int, term string")
    got = sorted(tuple(r) for r in T.query_vector(q, idf).collect())
    assert got == [(0, 0, 4.0)]


def test_one_pass_token_rule_equals_strip_then_check(spark):
    from tessera.functions.text import is_word, strip_outer_punct, word_of

    pieces = ["don't", "(hello)", "--naïve--", "u.s.", "42nd", "ab", "abc", "...", "", "x-ray",
              "«équipe»", "über!", "a1b", "1abc", "abc1", "'s", "n't", "ñandú,"]
    df = spark.createDataFrame([(p,) for p in pieces], "piece string")
    two_step = F.when(is_word(strip_outer_punct("piece")), strip_outer_punct("piece")).otherwise(F.lit(""))
    rows = df.select("piece", word_of("piece").alias("one"), two_step.alias("two")).collect()
    assert all(r.one == r.two for r in rows), [(r.piece, r.one, r.two) for r in rows if r.one != r.two]


def _bag_folder(spark, tmp_path):
    rows = [(1, "Dogs dog DOGS cat", "en", "web"), (1, "dogs bird", "de", "web"), (2, "bird", "de", "web"),
            (2, None, "en", "web"), (3, "", "en", "web"), (4, "boxes box", None, "web"), (5, "men man", "en", None),
            (6, "dogs", "de", "web"), (6, "dogs", "de", "web"), (7, "cats cat dogs boxes", "en", "web"), (None, "cat", "en", "web")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_rows_are_counted_where_they_lie(spark):
    docs = spark.createDataFrame([(1, "aaa bbb aaa's ccc aaa"), (2, ""), (3, None), (4, "... 12 no"), (5, "ddd")],
                                 "doc_id long, text string").coalesce(1)
    counts = T.counts_by_row(docs.repartition(64))
    assert {tuple(r) for r in counts.collect()} == {(1, "aaa", 3), (1, "bbb", 1), (1, "ccc", 1), (5, "ddd", 1)}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Aggregate" not in plan


def test_bag_of_words_merges_repeated_ids(spark, tmp_path):
    from tessera.plans import documents as D

    d = _bag_folder(spark, tmp_path)
    docs = D.docs(spark, d)
    want = {tuple(r) for r in T.token_counts(T.tokenize(docs)).collect()}
    got = [tuple(r) for r in D.raw_counts(spark, d).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in D.repeated_ids(spark, d).collect()} == {(1,), (2,), (6,)}
    # an id is English when any of its rows is, with or without a text
    english = {r.doc_id for r in D.bag_of_words(spark, d).where("english").select("doc_id").distinct().collect()}
    assert english == {1, 2, 7}


def test_only_terms_that_rules_can_change_meet_their_lemmas(spark):
    rows = spark.createDataFrame([(1, "dogs", 1), (1, "dog", 2), (2, "women", 1), (2, "glass", 3), (3, "stadt", 1), (3, None, 1)],
                                 "doc_id long, term string, cnt long")
    changes = spark.createDataFrame([("dogs", "dog"), ("women", "woman")], "term string, lemma string")
    want = sorted(map(str, T.with_lemma(rows, changes, "term").collect()))
    joined = T.with_lemma(rows, changes, "term", by_rule=True)
    assert sorted(map(str, joined.select("doc_id", "term", "cnt", "lemma").collect())) == want
    stop = spark.createDataFrame([("woman",)], "word string")
    tf = T.term_frequencies_from_counts(rows, changes, stop, with_lengths=True, by_rule=True)
    assert {tuple(r) for r in tf.collect()} == {(1, "dog", 3, 3), (2, "glass", 3, 3), (3, "stadt", 1, 1)}
