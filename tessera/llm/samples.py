"""Labelled rows to fit a classifier on: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                   max_rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(text, label, part)`` of at most ``max_rows`` labelled training rows,
    written to the shared folder.

    Training rows are those whose :func:`remainder` is not ``held_out`` and
    whose label is 0 or 1.  A text counts once for each id and label, however
    often the row is repeated; beyond ``max_rows`` the ones with the smallest
    hash are taken.  Both lists that are broadcast, of labels and of the rows
    chosen, hold at most ``max_rows`` ids and hashes; texts stay where they
    are.  ``part`` is 0, 1 or 2 by the id, for fits that leave a part out.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("__id").isNotNull()
               & (remainder("__id", modulus) != held_out)).distinct()
        .orderBy(F.xxhash64("__id"), "__id", "label").limit(max_rows)
    )
    texts = docs.select(docs[doc_id].alias("__doc"), docs[text].alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select(
        "__id", "label", F.xxhash64("text").alias("__hash"), "text")
    # an id may stand for any number of documents
    rows = (joined.select("__id", "label", "__hash").distinct()
            .orderBy(F.xxhash64("__id", "__hash"), "__id", "__hash", "label").limit(max_rows))
    part = F.pmod(F.xxhash64("__id"), F.lit(3)).cast("int").alias("part")
    sample = (joined.join(F.broadcast(rows), ["__id", "label", "__hash"])
              .groupBy("__id", "label", "__hash").agg(F.first("text").alias("text")).select("text", "label", part))
    path = shared_path(docs.sparkSession, "samples/texts")
    sample.write.parquet(path)
    return docs.sparkSession.read.schema(sample.schema).parquet(path)
