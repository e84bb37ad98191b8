"""Exact per-group row numbers that never put one hot group in one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts each group inside a
single task, so a key holding a third of the rows makes that task a third of
the job.  :func:`rank_within_groups` gives the same numbers by one lazy plan for
all inputs: a group is cut into ordered chunks of about ``hot_rows`` rows, the
chunk being a range of the leading hash key; chunk sizes are counted (map-side
combined), a running sum over a group's chunk counts gives each chunk's
offset, and rows are numbered inside ``(group, chunk)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hex_prefix_fraction

# Rows of a chunk: a group with more is split across tasks.
HOT_GROUP_ROWS = 2_000_000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def rank_within_groups(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[Column | str],
    *,
    hash_col: str,
    rank_col: str = "rn",
    size_col: str = "n",
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``rank_col`` (1-based row number in ``order_cols`` order) and
    ``size_col`` (group size) per group of ``group_cols``.

    ``order_cols[0]`` must be ``hash_col``, a lower-case hex hash string, so
    that ranges of its leading digits are ranges of the order.  Group keys
    must not be null.
    """
    order = _cols(order_cols)
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > hot_rows).withColumn(
        "_chunks", F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int"))
    # At most one group for every ``hot_rows`` rows, and two chunks: both tables
    # are sent whole, and rows are shuffled once, for their numbers.
    x = df.join(F.broadcast(hot), group_cols, "left").withColumn(
        "_chunk",
        F.when(F.col("_n").isNull(), F.lit(0)).otherwise(
            F.floor(hex_prefix_fraction(hash_col) * F.col("_chunks")).cast("int")),
    )
    counts = (
        x.where(F.col("_n").isNotNull())  # becomes an inner join: rows of hot groups only
        .groupBy(*group_cols, "_chunk")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    before = Window.partitionBy(*group_cols).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group_cols, "_chunk",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    y = x.join(F.broadcast(offsets), [*group_cols, "_chunk"], "left")
    w = Window.partitionBy(*group_cols, "_chunk")
    return (
        y.withColumn(rank_col, F.coalesce(F.col("_off"), F.lit(0))
                     + F.row_number().over(w.orderBy(*order)))
        .withColumn(size_col, F.coalesce(F.col("_n"), F.count(F.lit(1)).over(w)))
        .drop("_n", "_chunks", "_chunk", "_off")
    )


def top_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows per group, ranked 1..n.

    ``row_number() <= n`` lets Spark (3.5+) insert a partial per-group limit
    before the shuffle (``WindowGroupLimit``), so each task sends at most
    ``n`` rows per group and a hot group's final task sees
    ``n x map tasks`` rows, not the group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
