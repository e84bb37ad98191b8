"""Truncated SVD of the TF-IDF matrix and what is read from it (M3-M10, W8, W9,
T4, J10, F19).

The matrix never leaves the executors.  Its rows are written once as a
parquet table of sparse vectors under the shared folder (a lineage cut, so
a lost executor re-reads the table instead of re-running the text steps) and
passed over a few times by :mod:`.blocksvd` (or, when asked for, by Spark's
own ``IndexedRowMatrix.computeSVD``).  Only blocks of ``num_terms`` rows,
bounded by parameters, reach the driver.
``U * S`` is ``A * V``, computed document by document from the sorted sparse
rows and ``V``, which every executor gets once.  Sums run in term order, so
equal documents get equal vectors.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import VectorUDT
from pyspark.mllib.linalg.distributed import IndexedRowMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import shared_path
from . import blocksvd, innersearch
from .ranking import top_n_per_group

K = 25
RCOND = 1e-6
# Entries of ``V`` gathered at a time while documents are projected.
PROJECTED = 1 << 21


@dataclass
class Decomposition:
    """``s`` (descending) and ``V`` (``num_terms x k``), signs fixed, plus the
    same as tables: ``sigma(concept, s)`` and ``term_vectors(term_id, v)``."""
    s: np.ndarray
    V: np.ndarray
    sigma: DataFrame
    term_vectors: DataFrame


def doc_entries(tfidf: DataFrame) -> DataFrame:
    """``(doc_id, e)``: each document's ``(term_id, w)`` entries in term order."""
    return tfidf.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("term_id", "w"))).alias("e"))


def sparse_rows(spark: SparkSession, tfidf: DataFrame, num_terms: int) -> DataFrame:
    """``(doc_id, vec)``: one sparse vector per document with any entry.

    Entries are gathered per document (at most ``num_terms`` of them) into
    the storage layout of Spark's vector type, written as parquet under the
    shared folder, and read back typed as vectors, all on the JVM.
    """
    layout = VectorUDT().sqlType()
    entries = doc_entries(tfidf)
    fields = {
        "type": F.lit(0).cast(layout["type"].dataType),
        "size": F.lit(num_terms).cast(layout["size"].dataType),
        "indices": F.col("e.term_id"),
        "values": F.col("e.w"),
    }
    vec = F.struct(*[fields[f.name].alias(f.name) for f in layout.fields])
    path = shared_path(spark, "tfidf-rows")
    entries.select(F.col("doc_id").cast("bigint").alias("doc_id"), vec.alias("vec")) \
        .write.mode("overwrite").parquet(path)
    schema = StructType([StructField("doc_id", LongType()), StructField("vec", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def fix_signs(V: np.ndarray) -> np.ndarray:
    """Flip each column so its entry of largest magnitude (first one on ties) is positive."""
    V = V.copy()
    for j in range(V.shape[1]):
        i = int(np.argmax(np.abs(V[:, j])))
        if V[i, j] < 0:
            V[:, j] = -V[:, j]
    return V


def _gramian_svd(matrix: IndexedRowMatrix, k: int, rcond: float) -> tuple[np.ndarray, np.ndarray]:
    """``A^T A`` in one distributed pass (Spark), eigenvectors on the driver."""
    w, vecs = np.linalg.eigh(matrix.computeGramianMatrix().toArray())
    order = np.argsort(w)[::-1][:k]
    s = np.sqrt(np.clip(w[order], 0.0, None))
    keep = int(np.sum(s >= rcond * s[0])) if len(s) and s[0] > 0 else 0
    return s[:keep], vecs[:, order[:keep]]


def truncated_svd(spark: SparkSession, tfidf: DataFrame, num_terms: int, k: int = K,
                  rcond: float = RCOND, method: str = "block") -> Decomposition:
    """M3: the ``k`` largest singular values and right singular vectors.

    ``method``: ``"block"``, at every size, is the randomised block SVD (six
    passes over the rows).  Only when asked for: ``"arpack"``, Spark's
    ``computeSVD`` (about 90 passes over the persisted rows for k = 25), and
    ``"gramian"``, Spark's one-pass ``computeGramianMatrix`` with a
    ``num_terms x num_terms`` eigendecomposition on the driver.  Singular
    values below ``rcond * s_max`` are dropped, so fewer than ``k`` concepts
    may come back; callers loop over what is returned.
    """
    k_eff = max(1, min(k, num_terms))
    if method == "block":
        s, V = blocksvd.block_svd(blocksvd.entry_rows(spark, tfidf), num_terms, k_eff, rcond)
    else:
        rows = sparse_rows(spark, tfidf, num_terms).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            matrix = IndexedRowMatrix(rows, 0, num_terms)
            if method == "gramian":
                s, V = _gramian_svd(matrix, k_eff, rcond)
            else:
                svd = matrix.computeSVD(k_eff, computeU=False, rCond=rcond)
                s, V = np.asarray(svd.s.toArray(), dtype=float), np.asarray(svd.V.toArray(), dtype=float)
        finally:
            rows.unpersist()
    V = fix_signs(V) if len(s) else np.zeros((num_terms, 0))
    sigma = spark.createDataFrame([(j, float(v)) for j, v in enumerate(s)], "concept int, s double")
    return Decomposition(s, V, sigma, _vector_table(spark, V))


def _vector_table(spark: SparkSession, V: np.ndarray) -> DataFrame:
    """``(term_id, v)``, handed to Spark as Arrow columns."""
    n, k = V.shape
    lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, np.ascontiguousarray(V).ravel())
    return spark.createDataFrame(pa.table({"term_id": pa.array(np.arange(n, dtype=np.int32)), "v": lists}))


def term_concept(dec: Decomposition) -> DataFrame:
    """``(term_id, concept, v)`` in long form."""
    return dec.term_vectors.select("term_id", F.posexplode("v").alias("concept", "v"))


def doc_vectors(tfidf: DataFrame, dec: Decomposition, docs: DataFrame | None = None) -> DataFrame:
    """M4: ``(doc_id, us)``: row ``d`` of ``U * S`` as ``array<double>[k]``.

    ``A * V``, one document at a time: the terms' vectors, scaled by the
    entries and added in term order.  With ``docs``, documents without
    entries get a zero vector.
    """
    k, spark = len(dec.s), tfidf.sparkSession
    sent, block = spark.sparkContext.broadcast(dec.V), max(1, PROJECTED // max(1, k))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        V = sent.value
        for batch in batches:
            entries = batch.column(1)
            flat, ends = entries.flatten(), np.asarray(entries.offsets, dtype=np.int64)
            ends = ends - ends[0]
            terms, weights = np.asarray(flat.field("term_id")), np.asarray(flat.field("w"))
            row, sums = 0, np.zeros((batch.num_rows, k))
            while row < batch.num_rows:  # documents whose entries fit a block, at least one
                stop = max(row + 1, int(np.searchsorted(ends, ends[row] + block, "right")) - 1)
                lo, hi = ends[row], ends[stop]
                scaled = V[terms[lo:hi]] * weights[lo:hi, None]
                sums[row:stop] = np.add.reduceat(scaled, ends[row:stop] - lo, axis=0)
                row = stop
            us = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * k, sums.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), us], names=["doc_id", "us"])

    rows = doc_entries(tfidf).select(F.col("doc_id").cast("bigint").alias("doc_id"), "e")
    summed = rows.mapInArrow(project, "doc_id bigint, us array<double>")
    if docs is None:
        return summed
    zero = F.array_repeat(F.lit(0.0), k)
    return docs.select("doc_id").join(summed, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("us"), zero).alias("us"))


def doc_concept_scores(us: DataFrame) -> DataFrame:
    """``(doc_id, concept, score)`` in long form."""
    return us.select("doc_id", F.posexplode("us").alias("concept", "score"))


def concept_top_terms(dec: Decomposition, vocab: DataFrame, n: int = 25) -> DataFrame:
    """W8 + J10: ``(concept, rank, term_id, term, weight)``, the ``n`` largest
    signed weights per concept (ties by term id); a missing term name shows
    the id."""
    tc = term_concept(dec).withColumnRenamed("v", "weight")
    top = top_n_per_group(tc, ["concept"], [F.desc("weight"), F.col("term_id")], n)
    named = top.join(vocab.select("term_id", "term"), "term_id", "left")
    return named.select("concept", "rank", "term_id",
                        F.coalesce(F.col("term"), F.col("term_id").cast("string")).alias("term"),
                        "weight")


def concept_top_docs(us: DataFrame, dec: Decomposition, docs: DataFrame, n: int = 25) -> DataFrame:
    """``(concept, rank, doc_id, title, genre, u, score)``: the ``n``
    documents with the largest signed ``U`` value per concept (ties by doc id).

    ``score`` is the ``U * S`` entry, ``u = score / s``; genre defaults to
    ``unknown`` (J8).  The per-concept limit is applied before the shuffle.
    """
    scores = doc_concept_scores(us)
    top = top_n_per_group(scores, ["concept"], [F.desc("score"), F.col("doc_id")], n)
    top = top.join(dec.sigma, "concept")
    meta = docs.select("doc_id", "title", "genre")
    j = top.join(meta, "doc_id", "left")
    return j.select(
        "concept", "rank", "doc_id",
        F.coalesce(F.col("title"), F.col("doc_id").cast("string")).alias("title"),
        F.coalesce(F.col("genre"), F.lit("unknown")).alias("genre"),
        (F.col("score") / F.col("s")).alias("u"), "score")


def concept_genres(top_docs: DataFrame, m: int = 5) -> DataFrame:
    """``(concept, genres)``: genres of the first ``m`` documents, in rank order."""
    firsts = top_docs.where(F.col("rank") <= m)
    return firsts.groupBy("concept").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "genre"))),
                                 lambda x: x["genre"]), ", ").alias("genres"))


def concept_report_lines(top_terms: DataFrame, top_docs: DataFrame, m: int = 5) -> DataFrame:
    """M9 + F19: ``(concept, terms, docs, genres)``, each a ``", "``-joined list
    in rank order (at most ``n`` items per concept)."""
    def joined(df, value, name):
        return df.groupBy("concept").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", value))),
                                     lambda x: x[value]), ", ").alias(name))
    terms = joined(top_terms, "term", "terms")
    docs = joined(top_docs, "title", "docs")
    return terms.join(docs, "concept", "full").join(concept_genres(top_docs, m), "concept", "left")


def query_concepts(qv: DataFrame, dec: Decomposition, queries: DataFrame) -> DataFrame:
    """M6: ``(query_id, qc)``: ``V^T q`` as ``array<double>[k]`` for every
    query id in ``queries`` (zero vector when no word is known)."""
    k = len(dec.s)
    zero = F.array_repeat(F.lit(0.0), k)
    scaled = qv.join(dec.term_vectors, "term_id").select(
        "query_id", "term_id", F.transform("v", lambda x: x * F.col("w")).alias("wv"))
    summed = scaled.groupBy("query_id").agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("term_id", "wv"))), zero,
                    lambda acc, x: F.zip_with(acc, x["wv"], lambda a, b: a + b)).alias("qc"))
    ids = queries.select("query_id").distinct()
    return ids.join(summed, "query_id", "left").select(
        "query_id", F.coalesce(F.col("qc"), zero).alias("qc"))


def keyword_search(us: DataFrame, qc: DataFrame, docs: DataFrame, top: int = 10,
                   blocks: DataFrame | None = None) -> DataFrame:
    """M7 + M8 + T4: ``(query_id, rank, doc_id, title, genre, score)``, the
    ``top`` documents per query by ``(U S) (V^T q)`` (plain dot product; ties
    by doc id).

    One plan for any number of queries: documents lie in blocks with bounds,
    and only blocks that can hold a result are scored (see
    :mod:`.innersearch`; ``blocks`` is the written block table of ``us``, if
    there is one).
    """
    best = keyword_hits(us, qc, top, blocks).hits.withColumnRenamed("id", "doc_id")
    j = best.join(docs.select("doc_id", "title", "genre"), "doc_id", "left")
    return j.select("query_id", "rank", "doc_id",
                    F.coalesce(F.col("title"), F.col("doc_id").cast("string")).alias("title"),
                    F.coalesce(F.col("genre"), F.lit("unknown")).alias("genre"), "score")


def keyword_hits(us: DataFrame, qc: DataFrame, top: int = 10, blocks: DataFrame | None = None) -> innersearch.Search:
    """The search behind :func:`keyword_search`, with the pairs it scored."""
    if blocks is None:
        blocks = innersearch.blocks(us, "doc_id", "us")
    found = innersearch.search(blocks, qc, top, "query_id", "qc")
    return replace(found, hits=found.hits.withColumn("query_id", F.col("query_id").cast(qc.schema["query_id"].dataType)))
