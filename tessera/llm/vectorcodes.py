"""Vector codes: each of eight parts of a vector replaced by its nearest codebook entry.

Components become integers, ``floor(4096 * x)``.  The codebooks start as the
parts of the vectors with the smallest ids and are refined in rounds: every
part goes to the nearest entry, every entry to the floor of its parts' mean.

The nearest entry is found by memoised grid cells.  A part lies in a coarse
cell, a box of ``cell`` integers a side.  The smallest and the largest distance
from each entry to the box say which entries can be nearest somewhere in it:
one whose smallest distance exceeds another's largest is dominated.  What is
left is remembered under the cell (its coordinates are the key), and only
those entries are evaluated, exactly.  Every result is that of a full search.

A round is one pass over the table of integers, written once: a task sums its
parts by entry, Spark adds the sums up, and the driver receives ``16 * dim``
of them.  The codebooks are all that is sent to the tasks.

Defined results: rows with a null vector or with a null or non-finite
component are left out; a null id is a row as any other, after all ids where
the smallest are taken; of equal ids the smaller vector comes first; repeated
rows are coded alike.  Fewer rows than entries make as many entries; an empty
table gives an empty result.  An empty vector has eight empty parts.  Vectors
of different lengths, or of one that eight doesn't divide, are an error, and
so are components above 4e304 and an error that doesn't fit a long; below
that all arithmetic is exact (Python's integers where 64 bits may not do).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..session import shared_path
from . import textbatch as tb
from .shipping import ship

PARTS = 8
SCALE = 4096
#: Rows worked on together.
ROWS = 4096
#: Cells that a task remembers before it starts afresh.
REMEMBERED = 1 << 17

#: ``[part][entry]`` is a list of integers.
Codebooks = list[list[list[int]]]


def finite(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    def good(x: Column) -> Column:
        d = x.cast("double")
        return F.coalesce(~F.isnan(d) & (F.abs(d) < F.lit(math.inf)), F.lit(False))

    return vector.isNotNull() & F.forall(vector, good)


def integers(table: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``(vec_id, label, v, dim, top)`` of the finite rows, written to the
    shared folder: integers as little-endian doubles (which hold them
    exactly), their number and the largest magnitude."""
    spark = table.sparkSession
    ship(spark)
    schema = StructType([
        StructField("vec_id", table.schema[vec_id].dataType), StructField("label", table.schema[label].dataType),
        StructField("v", BinaryType()), StructField("dim", IntegerType()), StructField("top", DoubleType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            size = np.asarray(lists.value_lengths(), np.int64)
            with np.errstate(over="ignore"):
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype("<f8") * SCALE) + 0.0
            if not np.isfinite(flat).all():
                raise ValueError("a component times 4096 is too large for a double")
            end = np.cumsum(size)
            at = (end - size).tolist()
            top = [float(np.abs(flat[a:b]).max(initial=0.0)) for a, b in zip(at, end.tolist(), strict=True)]
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([raw[8 * a:8 * b] for a, b in zip(at, end.tolist(), strict=True)], pa.binary()),
                 pa.array(size.astype(np.int32)), pa.array(top, pa.float64())], names=schema.names)

    path = shared_path(spark, "codes/integers")
    rows = table.select(table[vec_id].alias("vec_id"), table[label].alias("label"), table[vector].alias("v"))
    rows = rows.where(finite(F.col("v"))).select("vec_id", "label", F.col("v").cast("array<double>").alias("v"))
    rows.mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def as_integers(raw: list[bytes], dim: int, exact64: bool) -> np.ndarray:
    """Rows of integers: 64-bit ones, or Python's."""
    flat = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dim)
    if exact64:
        return flat.astype(np.int64)
    return np.array([[int(x) for x in row] for row in flat.tolist()], object).reshape(len(raw), dim)


class Nearest:
    """The nearest entries of one part's codebook, by memoised cells."""

    def __init__(self, entries: list[list[int]], cell: int, kind: type):
        self.cell = cell
        self.kind = kind
        self.entries = np.array(entries, kind).reshape(len(entries), len(entries[0]) if entries else 0)
        self.known: dict[bytes | tuple, int] = {}
        self.evaluated = 0

    def _possible(self, cells: np.ndarray) -> list[int]:
        """Bit masks of the entries that no other dominates in each cell."""
        least = np.zeros((len(self.entries), len(cells)), self.kind)
        most = least.copy()
        for d in range(cells.shape[1]):
            low = (cells[:, d] * self.cell)[None, :]
            high = low + (self.cell - 1)
            e = self.entries[:, d:d + 1]
            near = np.maximum(np.maximum(low - e, e - high), 0)
            far = np.maximum(e - low, high - e)
            least += near * near
            most += far * far
        open_ = (least <= most.min(0)).astype(np.int64)
        return (open_ << np.arange(len(open_))[:, None]).sum(0).tolist()

    def masks(self, x: np.ndarray) -> np.ndarray:
        """Which entries to evaluate for each row, as bits."""
        cells = x // self.cell
        other = np.zeros(len(x), bool)
        if self.kind is object:
            keys = [tuple(c) for c in cells.tolist()]
            first = dict(zip(reversed(keys), range(len(keys) - 1, -1, -1), strict=True))
            names, one = list(first), np.array(list(first.values()), np.int64)
            number = {k: i for i, k in enumerate(names)}
            member = np.array([number[k] for k in keys], np.int64)
        else:
            mixed = np.zeros(len(cells), np.uint64)
            for d in range(cells.shape[1]):
                mixed = tb.mix(mixed + cells[:, d].astype(np.uint64))
            _, one, member = np.unique(mixed, return_index=True, return_inverse=True)
            other = (cells != cells[one][member]).any(1)  # a cell with another's hash: all its entries are evaluated
            names = [c.tobytes() for c in cells[one]]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [i for i, k in enumerate(names) if k not in self.known]
        for part in np.array_split(new, len(new) // 1024 + 1):
            if len(part):
                self.known.update(zip([names[i] for i in part.tolist()], self._possible(cells[one[part]]), strict=True))
        mask = np.array([self.known[k] for k in names], np.int64)[member]
        mask[other] = (1 << len(self.entries)) - 1
        return mask

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's entry (ties to the lower one) and squared distance."""
        n = len(x)
        code = np.zeros(n, np.int64)
        if not x.shape[1]:
            return code, np.zeros(n, self.kind)
        mask = self.masks(x)
        best = np.full(n, -1, self.kind)
        columns = np.ascontiguousarray(x.T)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero(mask >> k & 1)
            self.evaluated += len(rows)
            d = np.zeros(len(rows), self.kind)
            for column, value in zip(columns, entry, strict=True):
                away = column[rows] - value
                d += away * away
            better = (best[rows] < 0) | (d < best[rows])
            best[rows[better]] = d[better]
            code[rows[better]] = k
        return code, best


def _batches(batches, column: int, dim: int, exact64: bool):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, as_integers(part.column(column).to_pylist(), dim, exact64)


def _coders(books: Codebooks, cell: int, exact64: bool) -> list[Nearest]:
    return [Nearest(b, cell, np.int64 if exact64 else object) for b in books]


def refine(rows: DataFrame, books: Codebooks, dim: int, cell: int, exact64: bool) -> Codebooks:
    """One round: every part to its nearest entry, every used entry to the
    componentwise floor of its parts' mean."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    size = dim // PARTS
    schema = StructType([StructField("part", IntegerType()), StructField("entry", IntegerType()),
                         StructField("pos", IntegerType()), StructField("n", LongType()), StructField("s", StringType())])

    def run(batches):
        coders = _coders(sent.value, cell, exact64)
        count = np.zeros((PARTS, len(sent.value[0])), np.int64)
        total = np.zeros((*count.shape, size), object)
        for _, x in _batches(batches, 0, dim, exact64):
            for p, coder in enumerate(coders):
                own = x[:, p * size:(p + 1) * size]
                code, _ = coder(own)
                count[p] += np.bincount(code, minlength=count.shape[1])
                for k in np.unique(code).tolist():
                    total[p, k] += own[code == k].sum(0).astype(object)
        found = [(p, k, i, int(count[p, k]), str(total[p, k, i])) for p, k in np.argwhere(count).tolist() for i in range(size)]
        column = list(zip(*found, strict=True)) if found else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in column[:3]), pa.array(column[3], pa.int64()), pa.array(column[4], pa.string())],
            names=schema.names)

    sums = rows.select("v").mapInArrow(run, schema).groupBy("part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"))
    new = [[list(entry) for entry in book] for book in books]
    for r in sums.collect():  # at most 16 * dim rows
        new[r["part"]][r["entry"]][r["pos"]] = int(r["s"]) // r["n"]
    return new


def compress(table: DataFrame, entries: int = 16, rounds: int = 6, cell: int = 512, vec_id: str = "vec_id",
             vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, code, error)`` of every finite row, written to the
    shared folder, and the codebooks.

    ``code`` lists the entries in order of the parts, two hexadecimal digits
    each; ``error`` sums the squared distances.
    """
    if not 1 <= entries <= 63:
        raise ValueError("between 1 and 63 entries")
    spark = table.sparkSession
    rows = integers(table, vec_id, vector, label)
    low, high, top = rows.agg(F.min("dim"), F.max("dim"), F.max("top")).first()
    if low != high or (high or 0) % PARTS:
        raise ValueError(f"vectors need one length that {PARTS} divides, not {low} to {high}")
    dim = high or 0
    size = dim // PARTS
    # distances to an entry or a cell's corner, and sums over a block, fit 64 bits
    exact64 = size * (2 * int(top or 0) + 2 * cell) ** 2 < 1 << 62 and ROWS * int(top or 0) < 1 << 62
    source = table.select(table[vec_id].alias("vec_id"), table[vector].cast("array<double>").alias("v"))
    start = source.where(finite(F.col("v"))).orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    numbers = [[math.floor(x * SCALE) for x in r["v"]] for r in start]
    books: Codebooks = [[v[p * size:(p + 1) * size] for v in numbers] for p in range(PARTS)]
    if start and size:
        for _ in range(rounds):
            books = refine(rows, books, dim, cell, exact64)
    sent = spark.sparkContext.broadcast(books)
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()),
                         StructField("error", LongType())])

    def run(batches):
        coders = _coders(sent.value, cell, exact64)
        for batch, x in _batches(batches, 2, dim, exact64):
            code = np.zeros((len(x), PARTS), np.uint8)
            error = np.zeros(len(x), object)
            for p, coder in enumerate(coders):
                code[:, p], distance = coder(x[:, p * size:(p + 1) * size])
                error += distance.astype(object)
            if len(error) and error.max() >= 1 << 63:
                raise ValueError("an error does not fit a long")
            text = code.tobytes().hex()
            width = 2 * PARTS
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([text[i:i + width] for i in range(0, len(text), width)]),
                 pa.array([int(e) for e in error], pa.int64())], names=schema.names)

    path = shared_path(spark, "codes/coded")
    rows.select("vec_id", "label", "v").mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path), books


def digest(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` and ``label_error``, the errors summed over equal labels
    (nulls together): one row a label is joined back."""
    totals = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
