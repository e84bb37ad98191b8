"""The ``opN_<name>`` queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import bestfit, bpe, convtrie, jaccard, kdtree, language, licences, neighbours, packing, quality, repeats, toxicity, vectorcodes
from .samples import remainder


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: ``(doc_id, held_out, score, predicted)``."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"),
                         "quality.score", "quality.predicted")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: ``(doc_id, held_out, score, predicted, passages)``."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon, ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"),
                         "toxicity.score", "toxicity.predicted", "toxicity.passages")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: ``(doc_id, held_out, lang_pred, score)``."""
    docs = table(spark, sf_dir, "documents")
    profiles = language.fit(docs, remainder(docs["doc_id"], 4) != 2)
    named = language.predict(docs, profiles, ["doc_id"])
    return named.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"),
                        "language.lang_pred", "language.score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document and their decoding, as digests:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, tokens, public_tokenizers.PATTERN, ["doc_id"]).select("doc_id", "bpe.*")
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
    narrow = encoded.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                            digest.alias("ids_sha256"), "ids")
    decoded = bpe.decode(narrow, tokens, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256",
                          F.sha2("bytes.decoded", 256).alias("decoded_sha256"))


def word_bpe() -> str:
    """The definition of the word tokenizer."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` in sequences of at most 2048 tokens, with the checksum of their ids."""
    pieces = packing.pack(docs, word_bpe(), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
    return packed(table(spark, sf_dir, "documents"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector: ``(query_id, rank, vec_id, score)``."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of every 50th vector by integer inner product: ``(query_id, rank, vec_id, score)``."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: ``(doc_id, n_shingles, component_id, n_class)``."""
    return jaccard.near_copies(table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 200 bytes that repeat:
    ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return cut.select("doc_id", "repeats.n_bytes", "repeats.n_removed",
                      F.size("repeats.spans").cast("long").alias("n_spans"),
                      F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document: ``(doc_id, n_paragraphs, family, findings)``;
    ``family`` is that of the most probable finding; all-rights-reserved only
    if there is no other."""
    docs = table(spark, sf_dir, "documents")
    scanned = licences.scan(docs, licences.fit(docs), ["doc_id"]).select("doc_id", "licence.*")
    best = F.array_max(F.transform("findings", lambda x: F.struct(
        (x["family"] != licences.RESERVED).alias("grants"), x["probability"], x["family"])))
    return scanned.select("doc_id", "n_paragraphs", best["family"].alias("family"), "findings")


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens, cut only above that:
    ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    pieces = bestfit.pack(table(spark, sf_dir, "documents"), word_bpe(), end_id=1)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector: ``(vec_id, code, error, label_error, codebooks_sha256)``."""
    coded, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    return vectorcodes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of ``conversations``: ``(conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    return convtrie.trie(table(spark, sf_dir, "conversations"))
