"""Parquet tables of a data folder and the stand-in inputs derived from them.

The reference reads files that are not shipped (play counts, an alias list,
entity names, a plot table, a passenger table, stop words).  Each stand-in
below is a DataFrame plan over the parquet tables, so its work grows with
them; ``staging`` writes the same rows in the reference's file formats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import row_key

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def play_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Play counts ``(user, item, count, o_orderkey, l_linenumber)``.

    ``orders`` joined to ``lineitem`` on the order key: a customer "plays" a
    part ``l_quantity`` times.  The order key and line number are carried
    only to give every row a stable identity for the split order.
    """
    orders = table(spark, data_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").cast("bigint").alias("count"),
        F.col("o_orderkey"),
        F.col("l_linenumber"),
    )


def alias_pairs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Alias list ``(bad_id, good_id)``: parts sharing name and brand map to the smallest key.

    Grouping with ``min`` combines map-side, so a hot ``(name, brand)`` group
    never lands whole in one task; the join back is planned by AQE
    (broadcast when the measured side is small, skew splits otherwise).
    """
    part = table(spark, data_dir, "part").select("p_partkey", "p_name", "p_brand")
    good = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("good_id"))
    return (
        part.join(good, ["p_name", "p_brand"])
        .where(F.col("p_partkey") != F.col("good_id"))
        .select(F.col("p_partkey").alias("bad_id"), "good_id")
    )


def entity_names(spark: SparkSession, data_dir: str) -> DataFrame:
    """Entity names ``(id, name)`` from ``part``."""
    return table(spark, data_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def passenger_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """Passenger table: ``customer`` with ``c_name`` renamed to ``Name``."""
    return table(spark, data_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("Name"), "c_nationkey", "c_acctbal",
        "c_mktsegment")


def plot_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """Plot table ``(Title, Genre, Plot, lang, n_chars)`` from ``documents``."""
    return table(spark, data_dir, "documents").select(
        F.col("doc_id").cast("string").alias("Title"),
        F.col("source").alias("Genre"),
        F.col("text").alias("Plot"),
        "lang",
        "n_chars",
    )


def documents(spark: SparkSession, data_dir: str, *more: Column) -> DataFrame:
    """Documents keyed by ``doc_id`` as the concept operators expect them:
    ``(doc_id, title, genre, text)``, rows with any null dropped (P3), plus
    the columns ``more`` of the rows that stay."""
    columns = ["doc_id", "title", "genre", "text"]
    return (
        table(spark, data_dir, "documents")
        .select("doc_id", F.col("doc_id").cast("string").alias("title"),
                F.col("source").alias("genre"), "text", *more)
        .na.drop(subset=columns)
    )


def play_count_row_key(user: Column | str, item: Column | str,
                       order_key: Column | str, line: Column | str,
                       count: Column | str) -> Column:
    """Identity of one play-count row, used to order the per-user split."""
    return row_key(user, item, order_key, line, count)
