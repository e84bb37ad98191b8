"""Joins, lookups, distincts and counts.

Joins carry no broadcast hints: Catalyst and AQE choose from measured bytes
(a broadcast, or sort-merge with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def resolve_aliases(ratings: DataFrame, aliases: DataFrame, item_col: str = "item") -> DataFrame:
    """Replace ``item`` by its ``good_id`` when listed as a ``bad_id`` (one hop).

    ``aliases`` must have one row per ``bad_id`` (see ``parse_alias``).
    """
    a = aliases.select("bad_id", "good_id")
    joined = ratings.join(a, ratings[item_col] == a["bad_id"], "left")
    return (
        joined.withColumn(item_col, F.coalesce(F.col("good_id"), F.col(item_col)))
        .drop("bad_id", "good_id")
    )


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``."""
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``."""
    return df.join(keys, on, "left_anti")


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str,
                        value: str, out: str, default: Column) -> DataFrame:
    """Left join a ``(lookup_key, value)`` table; missing -> ``default``."""
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(value).alias("_lv"))
    j = df.join(lk, df[key] == lk["_lk"], "left")
    return j.withColumn(out, F.coalesce(F.col("_lv"), default)).drop("_lk", "_lv")


def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A repeated key keeps the value of its greatest ``order`` (last line wins)."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """A1: distinct rows over ``cols``."""
    return df.select(*cols).distinct()


def distinct_per_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """A2: number of distinct ``value`` per ``key``.

    Planned as two aggregations (by ``(key, value)``, then by ``key``), each
    combining map-side, so a key holding most rows is never one task's input.
    """
    return df.groupBy(key).agg(F.count_distinct(value).alias(out))


def sum_per_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """A3: ``sum(value)`` per ``key`` (partial sums map-side)."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append rows by column name, duplicates kept."""
    return a.unionByName(b)
