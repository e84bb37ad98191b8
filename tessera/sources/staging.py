"""Write stand-in inputs in the reference's file formats, once per application.

The reference reads tab/space-delimited text and CSV files.  The stand-ins
are DataFrame plans over the parquet tables; this module writes them as
those files under the shared folder (``spark.checkpoint.dir``) so that the
file readers in :mod:`.delimited` run on real files whose size grows with
the tables.  A file set is written once per (application, data folder,
kind) and reused.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path, shared_root
from . import tables

_WRITTEN: dict[tuple[str, ...], str] = {}


def _staged(spark: SparkSession, data_dir: str, kind: str,
            write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, shared_root(spark), data_dir, kind)
    path = _WRITTEN.get(key)
    if path is None:
        tag = re.sub(r"[^A-Za-z0-9]+", "_", data_dir.rstrip("/").rsplit("/", 1)[-1])
        path = shared_path(spark, f"staged/{kind}-{tag}")
        write(path)
        _WRITTEN[key] = path
    return path


def write_lines(df: DataFrame, path: str) -> None:
    """Write a one-string-column DataFrame as text lines."""
    df.write.mode("overwrite").text(path)


def alias_file(spark: SparkSession, data_dir: str) -> str:
    """``bad_id<TAB>good_id`` lines."""
    def write(path: str) -> None:
        a = tables.alias_pairs(spark, data_dir)
        write_lines(a.select(F.concat_ws("\t", "bad_id", "good_id").alias("value")), path)
    return _staged(spark, data_dir, "alias", write)


def names_file(spark: SparkSession, data_dir: str) -> str:
    """``id<TAB>name`` lines."""
    def write(path: str) -> None:
        n = tables.entity_names(spark, data_dir)
        write_lines(n.select(F.concat_ws("\t", "id", "name").alias("value")), path)
    return _staged(spark, data_dir, "names", write)


def play_count_file(spark: SparkSession, data_dir: str) -> str:
    """``user item count`` lines (single spaces)."""
    def write(path: str) -> None:
        p = tables.play_counts(spark, data_dir)
        write_lines(p.select(F.concat_ws(" ", "user", "item", "count").alias("value")), path)
    return _staged(spark, data_dir, "plays", write)


def passenger_csv(spark: SparkSession, data_dir: str) -> str:
    """Passenger table as CSV with a header line."""
    def write(path: str) -> None:
        (tables.passenger_table(spark, data_dir)
         .write.mode("overwrite").option("header", True).option("escape", '"')
         .csv(path))
    return _staged(spark, data_dir, "passengers", write)


def plot_csv(spark: SparkSession, data_dir: str) -> str:
    """Plot table as CSV: every field quoted, ``""`` for a quote, line breaks
    inside fields, white space kept as is."""
    def write(path: str) -> None:
        (tables.plot_table(spark, data_dir)
         .write.mode("overwrite")
         .option("header", True).option("quoteAll", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    return _staged(spark, data_dir, "plots", write)


def stopword_file(spark: SparkSession, data_dir: str, counts: DataFrame, top: int = 7,
                  tag: str = "") -> str:
    """Stop words, one per line: the ``top`` most frequent tokens of the
    English documents (by occurrences, ties by token), from the token count
    table ``counts`` ``(doc_id, term, cnt)``; with a column ``english`` its
    rows tell by themselves, and aren't joined with the documents."""
    from ..operators.textmining import frequent_terms

    def write(path: str) -> None:
        if "english" in counts.columns:
            en_counts = counts.where("english")
        else:
            english = tables.table(spark, data_dir, "documents").where(F.col("lang") == "en")
            en_counts = counts.join(english.select("doc_id"), "doc_id", "left_semi")
        words = frequent_terms(en_counts, top)
        write_lines(words.select(F.col("token").alias("value")), path)
    return _staged(spark, data_dir, f"stopwords{top}{tag}", write)
