"""The reference's own input files as sources for the same plans.

``plans.documents`` and ``plans.recommendations`` take either a parquet data
folder (the stand-ins) or one of these descriptors, so a user of the
reference can run every query on the files they have today.  Descriptors
are frozen (hashable): they key the tables stored once per application.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_sample_predicate, row_key
from ..functions.text import strip_ws
from . import delimited

# The new user's items used by the reference on its own play-count data.
REFERENCE_NEW_USER_ITEMS = (829, 930, 1811, 1001819, 1007435, 1004028, 250, 1004496)
# Fixed value: the distinct items a user must have there.
REFERENCE_MIN_ITEMS = 100


@dataclass(frozen=True)
class PlotFiles:
    """Document inputs: a CSV with a header and ``Title, Genre, Plot`` columns
    (quoted line breaks, ``""`` quotes; other columns ignored), a
    stop-word file (one word per line) and, if there are any, a noun lexicon
    (one word per line; without it the corpus's own terms are the lexicon)
    and irregular nouns (``word<TAB>lemma`` lines)."""
    csv_path: str
    stopwords_path: str
    lexicon_path: str | None = None
    exceptions_path: str | None = None


@dataclass(frozen=True)
class PlayFiles:
    """Recommender inputs: ``user item count`` lines, ``bad<TAB>good`` alias
    lines, ``id<TAB>name`` lines; the share of play-count lines kept, the
    new user's items, and the distinct items that a user must have to stay."""
    plays_path: str
    alias_path: str
    names_path: str
    sample_fraction: float = 0.3
    new_user_items: tuple[int, ...] = REFERENCE_NEW_USER_ITEMS
    min_items: int = REFERENCE_MIN_ITEMS


def documents(spark: SparkSession, src: PlotFiles) -> DataFrame:
    """``(doc_id, title, genre, text)`` from the plot CSV, rows with a null dropped.

    The file has no key: a row's id is a 63-bit hash of its content and of its
    number among equal rows, the same wherever and however the file is read.
    """
    raw = delimited.read_csv_multiline(spark, src.csv_path)
    kept = raw.select(F.col("Title").alias("title"), F.col("Genre").alias("genre"),
                      F.col("Plot").alias("text")).na.drop()
    identity = F.xxhash64("title", "genre", "text", "_occurrence")
    return _numbered(kept, "title", "genre", "text").select(
        identity.bitwiseAND(F.lit((1 << 63) - 1)).alias("doc_id"), "title", "genre", "text")


def stopwords(spark: SparkSession, src: PlotFiles) -> DataFrame:
    return delimited.read_stopwords(spark, src.stopwords_path)


def lexicon(spark: SparkSession, src: PlotFiles) -> DataFrame | None:
    """``(term)``: the noun lexicon, if one is given."""
    if src.lexicon_path is None:
        return None
    return delimited.read_stopwords(spark, src.lexicon_path).select(F.col("word").alias("term"))


def exceptions(spark: SparkSession, src: PlotFiles) -> DataFrame | None:
    """``(word, lemma)``: the irregular nouns, if any are given; lines without
    both fields are left out."""
    if src.exceptions_path is None:
        return None
    parts = F.split("value", "\t")
    return delimited.read_lines(spark, src.exceptions_path).select(
        strip_ws(F.get(parts, 0)).alias("word"), strip_ws(F.get(parts, 1)).alias("lemma")
    ).where("word <> '' AND lemma <> ''")


def _numbered(rows: DataFrame, *cols: str) -> DataFrame:
    """``rows[cols]`` with ``_occurrence``: 1..n among n equal rows.

    Equal rows are counted (map-side combined) and written out again by two
    generators, so neither a task nor an array holds all copies of a row.
    """
    step = 1 << 16
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.select(*cols, "_n", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / step))).alias("_block"))
    return blocks.select(*cols, F.explode(F.sequence(
        F.col("_block") * step + 1, F.least(F.col("_n"), (F.col("_block") + 1) * step))).alias("_occurrence"))


def plays(spark: SparkSession, src: PlayFiles) -> DataFrame:
    """``(user, item, count, row_id)``: the play-count lines kept by the hash
    sample (a line's identity is its content and its number among equal lines:
    file splits and folders don't matter, repeated lines are sampled independently), parsed strictly."""
    lines = _numbered(delimited.read_lines(spark, src.plays_path), "value")
    lines = lines.withColumn("_line", F.concat_ws("|", "value", F.col("_occurrence").cast("string")))
    if src.sample_fraction < 1.0:
        lines = lines.where(hash_sample_predicate(src.sample_fraction, "_line"))
    parsed = delimited.parse_ratings(lines, "_line")
    return parsed.select("user", "item", "count", row_key(F.col("_line")).alias("row_id"))


def aliases(spark: SparkSession, src: PlayFiles) -> DataFrame:
    return delimited.parse_alias(delimited.read_lines(spark, src.alias_path))


def names(spark: SparkSession, src: PlayFiles) -> DataFrame:
    """``(id, name)``, tolerant parse; a repeated id keeps its last line."""
    lines = delimited.read_lines(spark, src.names_path)
    return delimited.parse_names_last_wins(lines)
