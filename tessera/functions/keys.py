"""Row identities and hash predicates built from native column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^32: md5 prefixes of 8 hex digits are read as integers below this bound.
HASH_SPACE = 4294967296


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_key(*cols: Column | str) -> Column:
    """``md5(concat_ws('|', cols...))``: a lower-case hex identity of a row."""
    return F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in cols]))


def hex_prefix_fraction(hex_key: Column | str) -> Column:
    """First 8 hex digits of a hash key as a double in ``[0, 1)``.

    Monotone in the key's string order, so ranges of it are ranges of the key.
    """
    return F.conv(F.substring(_col(hex_key), 1, 8), 16, 10).cast("double") / F.lit(HASH_SPACE)


def hash_sample_predicate(fraction: float, *cols: Column | str) -> Column:
    """Keep a row when ``conv(substr(md5(key),1,8),16,10) < fraction * 2^32``.

    Unlike ``DataFrame.sample`` the choice depends only on the row's content,
    not on how the input happens to be partitioned, and it is a plain filter
    that Catalyst evaluates inside the scan stage.
    """
    bound = int(fraction * HASH_SPACE)
    return F.conv(F.substring(row_key(*cols), 1, 8), 16, 10).cast("bigint") < F.lit(bound)
