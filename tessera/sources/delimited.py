"""Readers for the reference's file inputs (S2-S8, S10), as native DataFrame plans.

Every parser is a ``split`` plus casts and filters on the ``value`` column of
``spark.read.text``; no line reaches a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip_ws
from ..operators.relational import last_value_per_key


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line and inferred column types.

    Inference costs an extra pass over the files; :func:`read_csv_typed`
    with an explicit schema is the production form.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S2 without inference: header line skipped, types from ``schema``."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_csv_multiline(spark: SparkSession, path: str,
                       columns: tuple[str, ...] | None = None) -> DataFrame:
    """S3: CSV whose quoted fields may hold line breaks and ``""`` quotes; all strings.

    With ``columns`` the schema is given (all strings) instead of read from
    the header, which saves a pass over the first file.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines ``(value string)``."""
    return spark.read.text(path)


def _with_line_order(lines: DataFrame) -> DataFrame:
    """Attach ``_order``: a struct that sorts like the lines of the files.

    A file split is read by one task in line order, so (file, split start,
    monotonically increasing id) orders every line.
    """
    return lines.withColumn(
        "_order",
        F.struct(
            F.col("_metadata.file_path").alias("f"),
            F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("i"),
        ),
    )


def _strict_int(field: Column) -> Column:
    """``field`` as bigint; a missing or non-integer one fails the job, whether
    or not the session has ANSI mode on."""
    bad = F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(field, F.lit("(no field)"))))
    number = field.try_cast("bigint")
    return F.when(number.isNull(), bad.cast("bigint")).otherwise(number)


def parse_alias(lines: DataFrame) -> DataFrame:
    """``bad<TAB>good`` lines -> ``(bad_id, good_id)``.

    Lines whose first field is blank are skipped (P6); other bad integers
    fail the job, as ``int()`` does.  A repeated ``bad_id`` keeps
    the value of its last line (``max_by`` over the line order, combined
    map-side, so a hot key is never gathered in one task).
    """
    parts = F.split(F.col("value"), "\t")
    parsed = (
        _with_line_order(lines)
        .where(strip_ws(parts.getItem(0)) != "")
        .select(
            _strict_int(strip_ws(F.get(parts, 0))).alias("bad_id"),
            _strict_int(strip_ws(F.get(parts, 1))).alias("good_id"),
            "_order",
        )
    )
    return last_value_per_key(parsed, "bad_id", "good_id", "_order")


def parse_names(lines: DataFrame) -> DataFrame:
    """``id<TAB>name`` lines -> ``(id, name)``, tolerant.

    Only lines with exactly two fields and an integer first field are kept;
    the name is stripped.  Invalid UTF-8 byte sequences become U+FFFD.
    """
    return _names(lines)


def _names(lines: DataFrame, *keep: str) -> DataFrame:
    parts = F.split(F.make_valid_utf8(F.col("value")), "\t", -1)
    return (
        lines.select(parts.alias("p"), *keep)
        .where(F.size("p") == 2)
        .select(
            F.col("p").getItem(0).try_cast("bigint").alias("id"),
            strip_ws(F.col("p").getItem(1)).alias("name"),
            *keep,
        )
        .where(F.col("id").isNotNull())
    )


def parse_names_last_wins(lines: DataFrame) -> DataFrame:
    """S6 as a lookup table: one row per id, the last line's name winning
    (``max_by`` over the line order, combined map-side)."""
    parsed = _names(_with_line_order(lines), "_order")
    return last_value_per_key(parsed, "id", "name", "_order")


def parse_ratings(lines: DataFrame, *keep: str) -> DataFrame:
    """``user item count`` lines (single spaces) -> ``(user, item, count)``
    plus the ``keep`` columns.

    Extra fields are ignored; a missing or non-integer field fails the job.
    """
    parts = F.split(F.col("value"), " ")
    return lines.select(
        _strict_int(F.get(parts, 0)).alias("user"),
        _strict_int(F.get(parts, 1)).alias("item"),
        _strict_int(F.get(parts, 2)).alias("count"),
        *keep,
    )


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stop-word file -> distinct ``(word)``; lines are taken as they are."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def match_names(lines: DataFrame, targets: list[str]) -> DataFrame:
    """S10 + P10: lines -> ``(id string, name)`` whose lower-cased, stripped
    name is in ``targets``.

    Undecodable bytes are dropped (not replaced), the whole line is stripped,
    and only lines with exactly two tab-separated fields count.
    """
    decoded = F.regexp_replace(F.make_valid_utf8(F.col("value")), "�", "")
    parts = F.split(strip_ws(decoded), "\t", -1)
    wanted = [t.lower().strip() for t in targets]
    return (
        lines.select(parts.alias("p"))
        .where(F.size("p") == 2)
        .select(F.col("p").getItem(0).alias("id"), F.col("p").getItem(1).alias("name"))
        .where(strip_ws(F.lower(F.col("name"))).isin(wanted))
    )
