"""Table basics over staged files: CSV scans, a view queried with SQL, previews,
line readers and counts (S2-S8, S10, K1, K2, K6, K7, P1-P3, P14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import hash_sample
from ..sources import delimited, staging, tables
from . import documents as D
from . import recommendations as R

VIEW_NAME = "passengers"
PLOT_COLUMNS = ("Title", "Genre", "Plot")
PREVIEW_ROWS = 5
PREVIEW_WIDTH = 80
SAMPLE_FRACTION = 0.3
# Names looked up in the entity-name file (mixed case and
# outer spaces on purpose; one is absent from the data).
TARGET_NAMES = ("Red Plate", " small widget", "HOT RING", "blue bolt ", "old rod", "no such part")


def csv_infer_scan(spark: SparkSession, d: str) -> DataFrame:
    """The passenger CSV with inferred types; the key comes back as int
    and is widened to bigint."""
    df = delimited.read_csv_inferred(spark, staging.passenger_csv(spark, d))
    return df.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def sql_view_projection(spark: SparkSession, d: str) -> DataFrame:
    """K1 + P2: register the passenger table as a view and select ``Name`` with SQL."""
    csv_infer_scan(spark, d).createOrReplaceTempView(VIEW_NAME)
    return spark.sql(f"SELECT Name FROM {VIEW_NAME}")


def csv_multiline_scan(spark: SparkSession, d: str) -> DataFrame:
    """S3 + P1: the plot CSV (quoted line breaks, ``""`` quotes), three columns."""
    raw = delimited.read_csv_multiline(spark, staging.plot_csv(spark, d))
    return raw.select(*PLOT_COLUMNS)


def drop_null_rows(spark: SparkSession, d: str) -> DataFrame:
    """Plot rows without a null in the three columns (a blank cell reads as null)."""
    return csv_multiline_scan(spark, d).na.drop()


def _shown(c: str, width: int) -> F.Column:
    col = F.col(c).cast("string")
    return F.when(F.length(col) > width,
                  F.concat(F.substring(col, 1, width - 3), F.lit("..."))).otherwise(col).alias(c)


def preview_rows(spark: SparkSession, d: str, n: int = PREVIEW_ROWS,
                 width: int = PREVIEW_WIDTH) -> DataFrame:
    """K2: ``show(n, truncate=width)`` as rows: first ``n`` by title, long
    values cut to ``width`` characters ending in ``...``."""
    df = drop_null_rows(spark, d)
    return df.orderBy("Title").limit(n).select(*[_shown(c, width) for c in PLOT_COLUMNS])


def text_lines_scan(spark: SparkSession, d: str) -> DataFrame:
    """The play-count file's lines."""
    return delimited.read_lines(spark, staging.play_count_file(spark, d))


def parse_alias(spark: SparkSession, d: str) -> DataFrame:
    """The alias file parsed."""
    return delimited.parse_alias(delimited.read_lines(spark, staging.alias_file(spark, d)))


def parse_names_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """The entity-name file parsed."""
    return delimited.parse_names(delimited.read_lines(spark, staging.names_file(spark, d)))


def parse_ratings_strict(spark: SparkSession, d: str) -> DataFrame:
    """The play-count file parsed."""
    return delimited.parse_ratings(text_lines_scan(spark, d))


def stopword_table(spark: SparkSession, d: str) -> DataFrame:
    """The stop-word file read back as distinct words."""
    return D.stopwords(spark, d)


def name_match_in_list(spark: SparkSession, d: str) -> DataFrame:
    """S10 + P10: entity-name lines whose name is one of ``TARGET_NAMES``."""
    lines = delimited.read_lines(spark, staging.names_file(spark, d))
    return delimited.match_names(lines, list(TARGET_NAMES))


def hash_sample_plays(spark: SparkSession, d: str, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """A 30% hash sample of the play counts ``(user, item, count)``."""
    plays = tables.play_counts(spark, d)
    sampled = hash_sample(plays, fraction, ["user", "item", "o_orderkey", "l_linenumber", "count"])
    return sampled.select("user", "item", "count")


def first_rating(spark: SparkSession, d: str) -> DataFrame:
    """K6: the first canonical rating in ``(user, item, rating, row_key)`` order."""
    r = R.ratings_canonical(spark, d)
    return r.orderBy("user", "item", "rating", "row_key").limit(1).select("user", "item", "rating")


def dataset_counts(spark: SparkSession, d: str) -> DataFrame:
    """K7 + A14: ``(metric, value)`` for the row counts the reference prints."""
    ratings = R.ratings_canonical(spark, d)
    split = R.split_ratings(spark, d)
    docs = D.docs(spark, d)

    def count_of(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
            F.lit(name).alias("metric"), "value")

    parts = [
        count_of("ratings", ratings),
        count_of("alias_rows", R.aliases(spark, d)),
        count_of("distinct_user_items", ratings.select("user", "item").distinct()),
        count_of("qualified_users", R.stored_qualified_users(spark, d)),
        count_of("train_rows", split.where(F.col("split") == "train")),
        count_of("test_rows", split.where(F.col("split") == "test")),
        count_of("documents", docs),
        count_of("stopwords", D.stopwords(spark, d)),
        # the stored bag of words has every token's count
        D.raw_counts(spark, d).agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("value")).select(
            F.lit("tokens").alias("metric"), "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
