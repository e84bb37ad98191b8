"""Sampling, per-user train/test split, k-fold assignment, global row index (P14,
W1-W4, P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_sample_predicate, hex_prefix_fraction
from .ranking import HOT_GROUP_ROWS, rank_within_groups


def hash_sample(df: DataFrame, fraction: float, key_cols: list[str]) -> DataFrame:
    """Keep a row when the hash of its key falls below ``fraction``.

    Reproducible whatever the partitioning (unlike Bernoulli ``sample``) and
    evaluated as a filter in the scan stage.
    """
    return df.where(hash_sample_predicate(fraction, *key_cols))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """P14 as the reference writes it: ``sample(False, fraction, seed)``.

    The rows chosen depend on the input partitioning; prefer :func:`hash_sample`.
    """
    return df.sample(False, fraction, seed)


def per_user_split(ratings: DataFrame, train_fraction: float = 0.8, *,
                   user_col: str = "user", key_col: str = "row_key",
                   tie_cols: tuple[str, ...] = ("item", "rating"),
                   folds: int | None = None, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Tag each row ``split = 'train' | 'test'``.

    Inside a user, rows are ordered by ``key_col`` (a hash of the whole row)
    then ``tie_cols``; the first ``greatest(1, floor(train_fraction * n))``
    are training rows.  Repeated ``(user, item)`` rows are kept as rows.

    With ``folds``, training rows also carry ``fold`` (null for test rows): they
    are the first rows of their user, so the row number that splits them is the
    one :func:`kfold_assign` would give, and one pass serves both.
    """
    ranked = rank_within_groups(
        ratings, [user_col], [key_col, *tie_cols], hash_col=key_col,
        rank_col="_rn", size_col="_cnt", hot_rows=hot_rows)
    n_train = F.greatest(F.lit(1), F.floor(F.col("_cnt") * F.lit(train_fraction)))
    tagged = ranked.withColumn(
        "split", F.when(F.col("_rn") <= n_train, F.lit("train")).otherwise(F.lit("test")))
    if folds is not None:
        tagged = tagged.withColumn("fold", F.when(F.col("split") == "train", _fold(user_col, folds)))
    return tagged.drop("_rn", "_cnt")


def _fold(user_col: str, k: int) -> Column:
    return F.pmod(F.col("_rn") + F.col(user_col), F.lit(k)).cast("int")


def kfold_assign(rows: DataFrame, k: int = 5, *, user_col: str = "user",
                 key_col: str = "row_key", tie_cols: tuple[str, ...] = ("item", "rating"),
                 hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``fold = (row number inside the user + user) mod k``.

    Folds are balanced to one row inside every user; the user offset spreads
    the remainders so fold sizes stay even overall.
    """
    ranked = rank_within_groups(
        rows, [user_col], [key_col, *tie_cols], hash_col=key_col,
        rank_col="_rn", size_col="_cnt", hot_rows=hot_rows)
    return ranked.withColumn("fold", _fold(user_col, k)).drop("_rn", "_cnt")


def global_index(rows: DataFrame, *, key_col: str = "row_key", tie_cols: tuple[str, ...] = ("user", "item", "rating"),
                 out: str = "index", hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Consecutive numbers from 0 over all rows, in the order of ``key_col``
    (a hash of the whole row) and ``tie_cols``.

    Ranges of the hash of about ``hot_rows`` rows are counted and numbered by
    themselves, offsets are a running sum over the ranges' counts.  One lazy
    plan; a hot user or item makes no range larger.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    ranges = F.greatest(F.lit(1), F.ceil(total / F.lit(hot_rows)))
    x = rows.withColumn("_range", F.floor(hex_prefix_fraction(key_col) * ranges).cast("bigint"))
    counts = x.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key_col, *tie_cols))
    return x.join(offsets, "_range").withColumn(out, (F.col("_off") + inside - 1).cast("bigint")).drop("_range", "_off")


def global_kfold(rows: DataFrame, k: int = 5, **order) -> DataFrame:
    """W2 as a global index modulo ``k``: folds differ by one row at most."""
    return global_index(rows, **order).withColumn("fold", (F.col("index") % k).cast("int"))


def kfold_partitions(assigned: DataFrame, k: int = 5) -> DataFrame:
    """Every row once per fold ``fold_id``, ``role = 'val'`` in its own fold
    and ``'train'`` in the others (a generator, no join)."""
    return (
        assigned.withColumn("fold_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .withColumn("role", F.when(F.col("fold") == F.col("fold_id"), F.lit("val"))
                    .otherwise(F.lit("train")))
    )
