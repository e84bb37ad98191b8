"""M3-M7: SVD against numpy, U*S = A*V, keyword search edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import concepts as C


def _coo(spark, A):
    rows = [(d, t, float(A[d, t])) for d in range(A.shape[0]) for t in range(A.shape[1]) if A[d, t] != 0]
    return spark.createDataFrame(rows, "doc_id bigint, term_id int, w double")


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(7)
    A = rng.random((30, 12)) * (rng.random((30, 12)) < 0.4)
    A[5, :] = 0.0  # a document without entries
    dec = C.truncated_svd(spark, _coo(spark, A), 12, k=4)
    s_np = np.linalg.svd(A, compute_uv=False)[:4]
    assert np.allclose(dec.s, s_np, rtol=1e-6)
    assert np.allclose(dec.V.T @ dec.V, np.eye(len(dec.s)), atol=1e-8)
    # signs: largest |v| of every concept is positive
    for j in range(dec.V.shape[1]):
        assert dec.V[np.argmax(np.abs(dec.V[:, j])), j] > 0
    docs = spark.range(30).select(F.col("id").alias("doc_id"))
    us = {r.doc_id: r.us for r in C.doc_vectors(_coo(spark, A), dec, docs).collect()}
    assert np.allclose(np.array([us[d] for d in range(30)]), A @ dec.V, atol=1e-12)
    assert us[5] == [0.0] * len(dec.s)


@pytest.mark.parametrize("method", ["gramian", "arpack", "block"])
def test_methods_agree(spark, method):
    rng = np.random.default_rng(11)
    A = rng.random((120, 110)) * (rng.random((120, 110)) < 0.2)
    dec = C.truncated_svd(spark, _coo(spark, A), 110, k=5, method=method)
    assert np.allclose(dec.s, np.linalg.svd(A, compute_uv=False)[:5], rtol=1e-8)
    _, _, vt = np.linalg.svd(A)
    ref = C.fix_signs(vt[:5].T)
    assert np.allclose(dec.V, ref, atol=1e-6)


def test_rank_one_matrix_keeps_one_concept(spark):
    u = np.arange(1, 9, dtype=float)
    v = np.array([1.0, 2.0, 0.0, 3.0, 1.0])
    A = np.outer(u, v)
    dec = C.truncated_svd(spark, _coo(spark, A), 5, k=4)
    assert len(dec.s) == 1
    assert np.isclose(dec.s[0], np.linalg.norm(u) * np.linalg.norm(v))


def test_keyword_search_unknown_and_repeated(spark):
    rng = np.random.default_rng(3)
    A = rng.random((15, 6))
    tfidf = _coo(spark, A)
    dec = C.truncated_svd(spark, tfidf, 6, k=3)
    docs = spark.range(15).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("title"),
                                  F.lit("g").alias("genre"))
    queries = spark.createDataFrame([(0, "none"), (1, "t2"), (1, "t2")], "query_id int, term string")
    qv = spark.createDataFrame([(1, 2, 2.0)], "query_id int, term_id int, w double")
    us = C.doc_vectors(tfidf, dec, docs)
    qc = C.query_concepts(qv, dec, queries)
    hits = C.keyword_search(us, qc, docs, top=10).collect()
    q0 = sorted((r["rank"], r.doc_id, r.score) for r in hits if r.query_id == 0)
    assert q0 == [(i + 1, i, 0.0) for i in range(10)]
    q1 = sorted((r["rank"], r.score) for r in hits if r.query_id == 1)
    scores = (A @ dec.V) @ (dec.V.T @ (np.eye(6)[2] * 2.0))
    assert np.allclose([s for _, s in q1], np.sort(scores)[::-1][:10])


def test_concept_top_terms_default_name(spark):
    V = np.array([[0.1, -0.9], [0.8, 0.2], [-0.5, 0.3]])
    dec = C.Decomposition(np.array([2.0, 1.0]), V,
                          spark.createDataFrame([(0, 2.0), (1, 1.0)], "concept int, s double"),
                          spark.createDataFrame([(t, V[t].tolist()) for t in range(3)], "term_id int, v array<double>"))
    vocab = spark.createDataFrame([(0, "a", 1), (1, "b", 1)], "term_id int, term string, df bigint")
    got = [(r.concept, r["rank"], r.term) for r in C.concept_top_terms(dec, vocab, 2).orderBy("concept", "rank").collect()]
    assert got == [(0, 1, "b"), (0, 2, "a"), (1, 1, "2"), (1, 2, "b")]


def test_keyword_search_takes_any_number_of_queries_in_one_plan(spark):
    rng = np.random.default_rng(4)
    A = rng.random((20, 6))
    tfidf = _coo(spark, A)
    dec = C.truncated_svd(spark, tfidf, 6, k=3)
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("title"),
                                  F.lit("g").alias("genre"))
    queries = spark.createDataFrame([(q, f"t{q % 6}") for q in range(400)], "query_id int, term string")
    qv = spark.createDataFrame([(q, q % 6, 1.0 + q) for q in range(400)], "query_id int, term_id int, w double")
    us = C.doc_vectors(tfidf, dec, docs)
    qc = C.query_concepts(qv, dec, queries)
    hits = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in C.keyword_search(us, qc, docs, top=5).collect()}
    assert len(hits) == 2000
    for q in range(400):
        scores = (A @ dec.V) @ (dec.V[q % 6] * (1.0 + q))
        assert np.allclose([hits[q, r + 1][1] for r in range(5)], np.sort(scores)[::-1][:5])
        assert [hits[q, r + 1][0] for r in range(5)] == np.argsort(-scores, kind="stable")[:5].tolist()


def test_equal_documents_get_equal_vectors_and_rank_by_id(spark):
    rng = np.random.default_rng(5)
    A = np.tile(rng.random((10, 40)) * (rng.random((10, 40)) < 0.5), (30, 1))
    tfidf = _coo(spark, A).repartition(7)
    dec = C.truncated_svd(spark, tfidf, 40, k=6)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("title"),
                                   F.lit("g").alias("genre"))
    us = C.doc_vectors(tfidf, dec, docs)
    vectors = {r.doc_id: tuple(r.us) for r in us.collect()}
    assert len(vectors) == 300 and all(vectors[d] == vectors[d % 10] for d in vectors)
    qv = spark.createDataFrame([(0, t, 1.0) for t in range(40)], "query_id int, term_id int, w double")
    hits = sorted((r["rank"], r.doc_id) for r in
                  C.keyword_search(us, C.query_concepts(qv, dec, qv), docs, top=30).collect())
    ids = [d for _, d in hits]
    assert ids == sorted(ids) and len({d % 10 for d in ids}) == 1


def test_query_vectors_are_searched_in_bounded_blocks(spark, capsys):
    us = spark.createDataFrame([(d, [float(d % 7), 1.0 + d % 3]) for d in range(50)], "doc_id long, us array<double>")
    qc = spark.createDataFrame([(q, [1.0 + q % 5, float(-q)]) for q in range(700)], "query_id int, qc array<double>")
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.lit("g").alias("genre"))
    blocks = C.innersearch._query_blocks(qc, "query_id", "qc").collect()
    sizes = [len(r.query_ids) // 8 for r in blocks]
    assert max(sizes) <= C.innersearch.QUERIES and sum(sizes) == 700
    found = C.keyword_search(us, qc, docs, top=3)
    found.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in found.collect())
    score = lambda q, d: (1.0 + q % 5) * (d % 7) - q * (1.0 + d % 3)
    want = [(q, i + 1, d, score(q, d)) for q in range(700)
            for i, d in enumerate(sorted(range(50), key=lambda d: (-score(q, d), d))[:3])]
    assert got == want
